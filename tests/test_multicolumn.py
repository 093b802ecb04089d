"""Outlier fences, unusual rows, association, missingness patterns and grouped imputation on small frames."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from staykit.operators import multivariate as M
from staykit.operators import outliers
from staykit.operators.impute import impute_grouped
from staykit.operators.missing_patterns import co_missing, missing_effect, missing_patterns
from staykit.operators.quantiles import grouped_quantiles, quantile_values
from staykit.operators.validate import validate

NAN = float("nan")


# outliers

def test_fences_by_plain_medians(spark):
    rnd = random.Random(3)
    values = [round(rnd.gauss(50, 9), 3) for _ in range(999)] + [1e9, 1e18, -1e12]
    df = spark.createDataFrame([(v, None if i % 4 else NAN, 7.0, "t", i) for i, v in enumerate(values)], "a double, gone double, same double, t string, i long")
    got = {r.column_name: r for r in outliers.outlier_report(df).collect()}
    m = statistics.median(values)
    mad = statistics.median(abs(v - m) for v in values)
    assert set(got) == {"a", "same", "i"} and (got["a"].center, got["a"].spread) == (m, mad)
    low, high = m - 3.5 * 1.4826 * mad, m + 3.5 * 1.4826 * mad
    assert (got["a"].n_low, got["a"].n_high) == (sum(v < low for v in values), sum(v > high for v in values)) and got["a"].n_high >= 2
    assert got["same"].low_fence is None and (got["same"].n_values, got["same"].n_low, got["same"].n_high) == (len(values), 0, 0)
    marked = validate(df, outliers.outlier_rules(df, outliers.fences(df)))
    assert marked.where(F.col("reasons").contains("a_outlier")).count() == got["a"].n_low + got["a"].n_high
    iqr = {r.column_name: r for r in outliers.outlier_report(df, ["a"], "iqr").collect()}["a"]
    q = np.percentile(values, [25, 75])
    assert iqr.low_fence == pytest.approx(q[0] - 1.5 * (q[1] - q[0])) and iqr.high_fence == pytest.approx(q[1] + 1.5 * (q[1] - q[0]))


def test_fences_of_nothing(spark):
    df = spark.createDataFrame([(None, "x")], "a double, t string")
    assert outliers.outlier_report(df).collect() == [] and outliers.outlier_rules(df, outliers.fences(df)) == {}
    with pytest.raises(ValueError):
        outliers.fences(df, method="other")


def test_outliers_of_many_magnitudes_take_more_passes_not_a_larger_task(spark):
    rnd = random.Random(4)
    values = [rnd.uniform(0, 1000) for _ in range(3000)] + [1e9, 1e18, 1e27, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantile_values(df, ["x"], [0.5, 0.99], bins=1024, most=8)["x"]
    assert got[0.5] == pytest.approx(statistics.median(values), rel=1e-15)
    assert quantile_values(df, ["x"], [0.5], bins=4096, most=1)["x"][0.5] == got[0.5]


# association and unusual rows

def made(n=800):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        a = rnd.gauss(0, 3)
        rows.append((i, a, 2 * a + rnd.gauss(0, 1), None if i % 9 == 0 else rnd.random(), 5.0, 3 * a + 1, rnd.choice("xyz"), rnd.choice(["p", "q", None])))
    rows.append((n, 3.0, -6.0, 0.5, 5.0, 10.0, "x", "p"))                     # each value is usual, the row is not
    return rows


SCHEMA = "id long, a double, b double, c double, k double, d double, s string, t string"


def test_numeric_association_equals_numpy(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.column_a, r.column_b): r for r in M.numeric_association(df, ["a", "b", "c", "k"]).collect()}
    assert got["a", "b"].correlation == pytest.approx(np.corrcoef([r[1] for r in rows], [r[2] for r in rows])[0, 1])
    full = [r for r in rows if r[3] is not None]
    assert got["a", "c"].n == len(full) and got["a", "c"].covariance == pytest.approx(np.cov([r[1] for r in full], [r[3] for r in full])[0, 1])
    assert got["a", "k"].correlation is None and M.numeric_association(df, ["a"]).collect() == []


def test_text_association(spark):
    rows = [(x, x, y, None) for x in "ab" for y in "uv" for _ in range(10)] + [("a", None, "u", None)]
    df = spark.createDataFrame(rows, "w string, x string, y string, z string")
    got = {(r.column_a, r.column_b): r for r in M.text_association(df).collect()}
    assert got["w", "x"].cramers_v == pytest.approx(1.0) and got["w", "x"].n == 40 and got["x", "y"].cramers_v == 0.0
    assert ("w", "z") not in got                                             # no row has both
    few = spark.createDataFrame([(f"v{i}", "x" if i < 50 else "y") for i in range(100)], "m string, n string")
    r = M.text_association(few, levels=3).first()
    assert r.levels_a == 4 and r.n == 100                                    # the rare values are one level
    assert M.text_association(few, ["m"]).collect() == []


def test_unusual_rows(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.unusual_rows(df, ["a", "b", "c"], 0.9999).collect()
    full = np.array([[r[1], r[2], r[3]] for r in rows if r[3] is not None])
    inverse, mean = np.linalg.inv(np.cov(full.T)), full.mean(axis=0)
    for r, x in zip(out, rows):
        if x[3] is None:
            assert r.distance2 is None and r.is_unusual is None
        else:
            d = np.array(x[1:4]) - mean
            assert r.distance2 == pytest.approx(d @ inverse @ d, abs=1e-9)
    assert [r.id for r in out if r.is_unusual] == [len(rows) - 1]
    same = {r.id: r.distance2 for r in M.unusual_rows(df, ["a", "b", "k", "d"]).collect()}      # constant and dependent columns add nothing
    two = {r.id: r.distance2 for r in M.unusual_rows(df, ["a", "b"]).collect()}
    assert same == pytest.approx(two)
    assert M.unusual_rows(df.limit(1), ["a", "b"]).first().distance2 is None and M.unusual_rows(df, ["k"]).first().is_unusual is None
    assert M.usual_limit(3, 0.999) == pytest.approx(16.266, rel=0.02)


# missingness

def test_patterns_pairs_and_effect(spark):
    rows = [(1.0, None, "x", 10.0)] * 3 + [(NAN, None, "x", 20.0)] * 2 + [(2.0, "y", "x", 30.0)] * 4 + [(3.0, "y", "x", None)]
    df = spark.createDataFrame(rows, "a double, b string, c string, price double")
    got = [(r.pattern, r.n_missing, r.n_rows, r.percent) for r in missing_patterns(df).collect()]
    assert got == [("", 0, 4, 40.0), ("b", 1, 3, 30.0), ("a,b", 2, 2, 20.0), ("price", 1, 1, 10.0)]
    pairs = {(r.column_a, r.column_b): (r.n_both, r.n_only_a, r.n_only_b, r.n_neither) for r in co_missing(df).collect()}
    assert pairs == {("a", "b"): (2, 0, 3, 5), ("a", "price"): (0, 2, 1, 7), ("b", "price"): (0, 5, 1, 4)}
    x, y = np.array([r[0] != r[0] for r in rows], float), np.array([r[1] is None for r in rows], float)
    assert co_missing(df, ["a", "b"]).first().phi == pytest.approx(np.corrcoef(x, y)[0, 1])
    effect = {r.column_name: r for r in missing_effect(df, "price").collect()}
    assert (effect["b"].n_missing, effect["b"].n_present, effect["b"].difference) == (5, 4, 14.0 - 30.0)
    assert effect["c"].difference is None and effect["c"].n_missing == 0 and effect["b"].t < 0
    none = df.limit(0)
    assert missing_patterns(none).collect() == [] and co_missing(none).collect() == [] and missing_effect(none, "price").first().n_present == 0


# groups

def test_grouped_quantiles_equal_plain_medians(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["a", "b", None, "hot", "hot", "hot"]), rnd.choice([1, 2]), rnd.choice([rnd.gauss(0, 5), 3.0, None, NAN, 1e15]), i % 7) for i in range(2500)]
    rows += [("only", 1, None, 5)]
    df = spark.createDataFrame(rows, "g string, h long, x double, y long")
    got = {(r.g, r.h, r.column_name): (r.n, r.value) for r in grouped_quantiles(df, ["g", "h"], ["x", "y"], bins=8, most=20).collect()}
    want = {}
    for g, h in {(r[0], r[1]) for r in rows}:
        for at, name in ((2, "x"), (3, "y")):
            v = [float(r[at]) for r in rows if (r[0], r[1]) == (g, h) and r[at] is not None and r[at] == r[at]]
            if v:
                want[g, h, name] = (len(v), statistics.median(v))
    assert got == want
    assert grouped_quantiles(df.limit(0), ["g"], ["x"]).collect() == []


def test_impute_grouped_backs_off_and_names_the_level(spark):
    rows = [(1, "n1", "r1", 2.0, "u"), (2, "n1", "r1", 4.0, "u"), (3, "n1", "r1", None, None), (4, "n2", "r1", None, "w"), (5, "n2", "r2", NAN, None),
            (6, None, "r1", None, None), (7, None, "r1", 9.0, "v"), (8, "n3", "r3", None, None)]
    df = spark.createDataFrame(rows, "id long, n string, r string, x double, s string")
    levels = [["n", "r"], ["r"], []]
    got = {r.id: (r.x, r.x_imputed, r.x_imputed_from) for r in impute_grouped(df, ["x"], levels).collect()}
    assert got == {1: (2.0, False, None), 2: (4.0, False, None), 3: (3.0, True, "n+r"), 4: (4.0, True, "r"), 5: (4.0, True, "all"),
                   6: (9.0, True, "n+r"), 7: (9.0, False, None), 8: (4.0, True, "all")}
    wide = {r.id: r.x_imputed_from for r in impute_grouped(df, ["x"], levels, support=3).where("x_imputed").collect()}
    assert wide == {3: "r", 4: "r", 5: "all", 6: "r", 8: "all"}
    out = impute_grouped(df, ["s", "x"], levels, "mode")
    assert out.columns == ["id", "n", "r", "x", "s", "s_imputed", "s_imputed_from", "x_imputed", "x_imputed_from"]
    assert {r.id: (r.s, r.s_imputed_from) for r in out.where("s_imputed").collect()} == {3: ("u", "n+r"), 5: ("u", "all"), 6: ("v", "n+r"), 8: ("u", "all")}
    assert impute_grouped(df, ["x"], levels, "mean").where("id = 4").first().x == 5.0
    nothing = impute_grouped(df.where("id in (3, 8)"), ["x"], levels).collect()
    assert all(r.x is None and r.x_imputed and r.x_imputed_from is None for r in nothing)
    with pytest.raises(ValueError):
        impute_grouped(df, ["x"], levels, "other")
