"""Shared folder resolution and table scans."""

from staykit.session import checkpoint_root, shared_path
from staykit.sources.tables import read_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == root.rstrip("/")
    p = shared_path(spark, "x", "y", unique=True)
    assert p.startswith(root.rstrip("/") + "/staykit/x/y/")
    assert p != shared_path(spark, "x", "y", unique=True)


def test_shared_path_makes_no_folder_on_the_driver(spark):
    import os

    assert not os.path.exists(shared_path(spark, "nothing", "here", unique=True).removeprefix("file:"))


def test_table_scans_are_left_alone(spark, tmp_dir):
    spark.range(0, 1000, numPartitions=1).write.parquet(tmp_dir + "/one.parquet")
    assert "Exchange" not in plan_of(read_table(spark, tmp_dir, "one"))


def test_clear_workspace_drops_tables_and_files(spark, tmp_dir):
    from staykit.session import clear_workspace

    path = shared_path(spark, "tables", "left_over", unique=True)
    spark.range(3).write.parquet(path)
    spark.sql(f"CREATE TABLE left_over USING parquet LOCATION '{path}'")
    spark.range(2).write.parquet(tmp_dir + "/other")
    spark.sql(f"CREATE TABLE not_ours USING parquet LOCATION '{tmp_dir}/other'")
    clear_workspace(spark)
    assert not spark.catalog.tableExists("left_over") and spark.read.table("not_ours").count() == 2
    spark.sql("DROP TABLE not_ours")
