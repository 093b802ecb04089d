"""Session construction and the shared working folder.

Everything that must outlive a task (staged files, tables written by the
sinks, streaming checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. That folder is read from the session; a private
one is created only when the setting is absent and Spark runs in local
mode (tests, the bench). On a cluster without the setting we refuse to
guess, because a machine-local temp folder is not visible to executors.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    app: str = "staykit",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every operator here assumes.

    AQE stays on (partition coalescing and skew-join splitting at run time);
    the session time zone is pinned to UTC so date arithmetic is the same on
    every executor; the UI is off because nothing here serves pages.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For sessions whose workers don't start in the repository. On a cluster the
    package is shipped as usual (``--py-files`` or installed); then the extra
    path is harmless.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set only if unset."""
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY, None
    )
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; point it at a folder every executor can reach"
            )
        root = tempfile.mkdtemp(prefix="staykit-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh id."""
    pieces = [checkpoint_root(spark), "staykit", *(p.strip("/") for p in parts)]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(pieces)             # Spark's writers make the folder, on any filesystem


def clear_workspace(spark: SparkSession) -> None:
    """Remove what the registered queries and the pipeline left behind.

    They keep everything under one root, ``<spark.checkpoint.dir>/staykit``:
    staged feeds, tables, streams, pipeline stages. Catalog tables with a
    location there are dropped, then the root is deleted. Call it when no job
    uses any of it.
    """
    root = f"{checkpoint_root(spark)}/staykit"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = fs.makeQualified(path).toString() + "/"
    for db in spark.catalog.listDatabases():
        for t in spark.catalog.listTables(db.name):
            if t.isTemporary:
                continue
            name = f"`{db.name}`.`{t.name}`"
            rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
            if str(rows.get("Location", "")).startswith(inside):
                spark.sql(f"DROP TABLE {name}")
    fs.delete(path, True)
