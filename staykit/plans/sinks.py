"""Table sinks and load metadata.

Tables live in the session catalog with explicit locations in the shared
folder, written by executors through Spark's commit protocol: a task lost
mid-write is retried and only committed files become visible, so a job
survives executor loss without leaving partial rows behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import to_timestamp_ntz


def add_metadata_columns(df: DataFrame, area: str, now=None) -> DataFrame:
    """Stamp rows with ``processing_datetime`` (``now``, default the load time)
    and ``area``."""
    return df.withColumns({"processing_datetime": to_timestamp_ntz(now), "area": F.lit(area)})


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table_if_missing(spark: SparkSession, name: str, schema: StructType,
                            location: str | None = None, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a contract (format is a parameter)."""
    loc = f" LOCATION '{location}'" if location else ""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING {fmt}{parts}{loc}")


def _by_name(df: DataFrame, target: StructType, name: str) -> list[Column]:
    """The frame's columns in the table's order and types; nulls for those it lacks."""
    extra = [c for c in df.columns if c not in target.fieldNames()]
    if extra:
        raise ValueError(f"columns not in {name}: {extra}")
    have = set(df.columns)
    return [F.col(f.name).cast(f.dataType) if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]


def replace_partitions(df: DataFrame, name: str, partition: dict[str, str]) -> None:
    """Make ``df`` (matched by name) the rows of one partition of a partitioned table.

    Rows of the partition from an earlier run go, those of all others stay.
    An empty frame empties the partition. Several writers may replace
    different partitions of a table at a time.
    """
    spark = df.sparkSession
    target = StructType([f for f in spark.read.table(name).schema.fields if f.name not in partition])
    view = f"_replace_{uuid.uuid4().hex}"
    df.select(*_by_name(df, target, name)).createOrReplaceTempView(view)
    where = ", ".join("`" + c + "` = '" + v.replace("'", "''") + "'" for c, v in partition.items())
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({where}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append matching columns by name; table columns the frame lacks get
    nulls, frame columns the table lacks are an error (no silent drops).
    Running it twice appends twice: there is no key to merge on."""
    spark = df.sparkSession
    df.select(*_by_name(df, spark.read.table(name).schema, name)).write.insertInto(name)


def _location(spark: SparkSession, name: str) -> tuple[str, str]:
    """(table type, location) of a catalog table."""
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return rows.get("Type", ""), rows.get("Location", "")


def overwrite_table(df: DataFrame, name: str, location: str | None = None,
                    fmt: str = "parquet") -> None:
    """Replace a table's rows *and* schema.

    With a ``location`` the new rows go to a fresh version folder under it.
    Only after that write has committed is the catalog changed: with the same
    schema by one ``ALTER TABLE ... SET LOCATION``, otherwise by building the
    new entry under a spare name and renaming twice, the old entry put back
    if the second rename fails. A job that fails midway leaves the previous
    version in place, and the frame may read the very table it replaces. A
    managed table is refused, since replacing its entry would delete its
    files. Old versions stay until :func:`vacuum_versions`. Without a
    location this is Spark's managed ``saveAsTable`` overwrite.
    """
    spark = df.sparkSession
    if not location:
        df.write.mode("overwrite").format(fmt).saveAsTable(name)
        return
    exists = spark.catalog.tableExists(name)
    if exists and _location(spark, name)[0].upper() == "MANAGED":
        raise ValueError(f"{name} is a managed table; overwrite it without a location")
    version = f"{location.rstrip('/')}/v_{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(version)
    if not exists:
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{version}'")
        return
    if spark.read.table(name).schema == spark.read.format(fmt).load(version).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
        return
    spare = f"{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {spare}_new USING {fmt} LOCATION '{version}'")
    spark.sql(f"ALTER TABLE {name} RENAME TO {spare}_old")
    try:
        spark.sql(f"ALTER TABLE {spare}_new RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {spare}_old RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {spare}_old")            # external: its files stay


def vacuum_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Delete old version folders of a table, all but the current and the newest
    ``keep`` others; returns the deleted paths. No reader may still use them."""
    current = _location(spark, name)[1]
    path = spark._jvm.org.apache.hadoop.fs.Path(current)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    others = sorted((s for s in fs.listStatus(path.getParent())
                     if s.getPath().getName().startswith("v_") and s.getPath().getName() != path.getName()),
                    key=lambda s: -s.getModificationTime())
    gone = [str(s.getPath()) for s in others[keep:]]
    for s in others[keep:]:
        fs.delete(s.getPath(), True)
    return gone
