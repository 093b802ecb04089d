"""Profiles: describe, summary, profile, histogram, frequencies."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from staykit.operators import profile

VALS = [1.0, 2.0, 2.0, 5.0, None, float("nan"), 10.0]


def frame(spark):
    rows = [(i, v, s) for i, (v, s) in enumerate(zip(VALS, ["b", "a", None, "c", "a", "a", "z"]))]
    return spark.createDataFrame(rows, "id long, x double, s string")


def present():
    return [v for v in VALS if v is not None and v == v]


def test_describe_long(spark):
    got = {r.column_name: r for r in profile.describe_long(frame(spark)).collect()}
    x = got["x"]
    assert x["count"] == 5 and x["min"] == 1.0 and x["max"] == 10.0
    assert abs(x["mean"] - np.mean(present())) < 1e-12
    assert abs(x["stddev"] - np.std(present(), ddof=1)) < 1e-12
    s = got["s"]
    assert (s["count"], s["min_text"], s["max_text"], s["mean"]) == (6, "a", "z", None)


def test_describe_keeps_nan_when_asked(spark):
    x = {r.column_name: r for r in profile.describe_long(frame(spark), nan_as_missing=False).collect()}["x"]
    assert x["count"] == 6 and np.isnan(x["max"])


def test_summary_exact_matches_numpy(spark):
    x = {r.column_name: r for r in profile.summary_long(frame(spark), exact=True).collect()}["x"]
    q = np.quantile(present(), [0.25, 0.5, 0.75])
    assert (x["p25"], x["p50"], x["p75"]) == tuple(q)
    assert x["iqr"] == q[2] - q[0]


def test_summary_approx_close(spark):
    df = spark.range(10000).select(F.col("id").cast("double").alias("v"))
    r = profile.summary_long(df).first()
    assert abs(r["p50"] - 4999.5) <= 10000 * profile.RANK_ERROR


def test_profile_exact_distinct(spark):
    got = {r.column_name: r for r in profile.profile(frame(spark), exact=True).collect()}
    assert got["x"]["distinct_count"] == 4
    assert got["s"]["distinct_count"] == 4
    assert got["x"]["missing_count"] == 2 and got["x"]["zero_count"] == 0
    assert got["s"]["n_rows"] == 7


def test_distinct_counts_match_pandas(spark):
    df = spark.createDataFrame(
        [(1, -0.0, "a"), (1, 0.0, "1"), (2, 0.5, None), (None, None, "a")], "i long, d double, s string")
    got = {r.column_name: r.distinct_count for r in profile.distinct_counts(df, df.columns).collect()}
    pdf = pd.DataFrame({"i": [1, 1, 2, None], "d": [0.0, 0.0, 0.5, None], "s": ["a", "1", None, "a"]})
    assert got == {c: pdf[c].nunique() for c in pdf}


def test_histogram_bins_sum_to_present(spark):
    rows = profile.histogram(frame(spark), "x", 3).orderBy("bin").collect()
    assert [r.bin for r in rows] == [0, 1, 2]
    assert sum(r["count"] for r in rows) == len(present())
    assert rows[-1].bin_hi == 10.0 and rows[0].bin_lo == 1.0
    assert [r["count"] for r in rows] == [3, 1, 1]


def test_histogram_constant_column_is_one_bin(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    rows = profile.histogram(df, "x", 5).collect()
    assert [(r.bin, r["count"]) for r in rows] == [(0, 2)]


def test_value_counts_null_group(spark):
    rows = profile.value_counts(frame(spark), "s").collect()
    assert (rows[0].s, rows[0]["count"]) == ("a", 3)
    assert any(r.s is None for r in rows)


def test_top_values(spark):
    rows = profile.top_values(frame(spark), ["s"], k=2).orderBy("rank").collect()
    assert [(r.value, r["count"], r["rank"]) for r in rows] == [("a", 3, 1), (None, 1, 2)]


def test_top_values_plans_group_limit_before_shuffle(spark):
    plan = profile.top_values(frame(spark), ["s", "x"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_reports_on_frames_without_eligible_columns(spark):
    from staykit.operators.missing import missing_stats
    from staykit.operators.quantiles import exact_quantiles
    text_only = spark.createDataFrame([("a",)], "s string")
    assert [(r["count"], r.min_text, r.p50) for r in profile.summary_long(text_only).collect()] == [(1, "a", None)]
    assert profile.summary_long(text_only).columns[-1] == "iqr"
    assert profile.histograms(text_only, []).count() == 0
    assert exact_quantiles(text_only, [], [0.5]).count() == 0
    assert profile.describe_long(spark.createDataFrame([(True,)], "b boolean")).count() == 0
    assert missing_stats(text_only, columns=[]).count() == 0
    assert profile.profile(text_only, columns=[]).count() == 0
