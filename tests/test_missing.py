"""Missing-value report and chart frames."""

from pyspark.sql import functions as F

from staykit.operators.missing import missing_bar, missing_pie, missing_stats
from staykit.registry import QUERIES
from tests.conftest import SF_SMALL


def frame(spark):
    rows = [(1.0, "a", 1), (float("nan"), None, 2), (None, "c", None), (4.0, "d", 4)]
    return spark.createDataFrame(rows, "x double, s string, n long")


def test_counts_and_percent(spark):
    got = {r.column_name: (r.missing_count, r.missing_percent)
           for r in missing_stats(frame(spark)).collect()}
    assert got == {"x": (2, 50.0), "s": (1, 25.0), "n": (1, 25.0)}


def test_ordered_by_percent_then_name(spark):
    names = [r.column_name for r in missing_stats(frame(spark)).collect()]
    assert names == ["x", "n", "s"]


def test_empty_input_gives_null_percent(spark):
    rows = missing_stats(frame(spark).filter(F.lit(False))).collect()
    assert all(r.missing_count == 0 and r.missing_percent is None for r in rows)


def test_missing_plus_present_is_rows(spark):
    df = QUERIES["scan_project_wide"](spark, SF_SMALL).drop("id")
    n = df.count()
    for r in missing_stats(df).collect():
        present = df.filter(F.col(r.column_name).isNotNull()).count()
        if dict(df.dtypes)[r.column_name] == "double":
            present = df.filter(F.col(r.column_name).isNotNull() & ~F.isnan(r.column_name)).count()
        assert r.missing_count + present == n


def test_bar_keeps_strictly_between(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, 3)], "a long, b long, c long")
    assert [r.column_name for r in missing_bar(missing_stats(df)).collect()] == ["c"]


def test_pie(spark):
    got = {r.status: r["count"] for r in missing_pie(frame(spark), "x").collect()}
    assert got == {"Missing": 2, "Not Missing": 2}


def test_one_scan_one_job_plan(spark):
    plan = missing_stats(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1
