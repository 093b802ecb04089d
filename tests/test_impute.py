"""Imputation with flags."""

import statistics

from staykit.operators.impute import fill_constant, impute

ROWS = [(1, 1.0, "a"), (2, None, "b"), (3, 3.0, None), (4, float("nan"), "b"), (5, 8.0, "a")]


def frame(spark):
    return spark.createDataFrame(ROWS, "id long, x double, c string")


def values(df, col):
    return {r.id: (r[col], r[col + "_imputed"]) for r in df.collect()}


def test_mean_with_flags(spark):
    got = values(impute(frame(spark), ["x"], "mean"), "x")
    mean = statistics.mean([1.0, 3.0, 8.0])
    assert got == {1: (1.0, False), 2: (mean, True), 3: (3.0, False), 4: (mean, True), 5: (8.0, False)}


def test_median_and_zero(spark):
    assert values(impute(frame(spark), ["x"], "median"), "x")[2] == (3.0, True)
    assert values(impute(frame(spark), ["x"], "median_approx"), "x")[4] == (3.0, True)
    assert values(impute(frame(spark), ["x"], "zero"), "x")[4] == (0.0, True)


def test_mode_lowest_on_ties(spark):
    got = values(impute(frame(spark), ["c"], "mode"), "c")
    assert got[3] == ("a", True)           # a and b both appear twice
    assert got[2] == ("b", False)


def test_category(spark):
    assert values(impute(frame(spark), ["c"], "category"), "c")[3] == ("__missing__", True)


def test_fill_constant_fills_nan(spark):
    got = values(fill_constant(frame(spark), {"x": 0}), "x")
    assert got[4] == (0.0, True) and got[1] == (1.0, False)


def test_no_join_in_plan(spark):
    plan = impute(frame(spark), ["x"], "mean")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert "Subquery" in plan
