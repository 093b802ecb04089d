"""Bounded exact quantiles equal Spark's exact percentile."""

import random

import pytest
from pyspark.sql import functions as F

from staykit.operators.impute import impute
from staykit.operators.quantiles import approx_quantiles, exact_median, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        a = 7.0 if i % 3 == 0 else rnd.gauss(0, 10)     # a value held by a third of the rows
        b = float(rnd.randint(0, 50)) if i % 5 else None
        c = rnd.randint(-5, 5) if i % 7 else None
        d = float("nan") if i % 11 == 0 else rnd.random()
        rows.append((a, b, c, d))
    return spark.createDataFrame(rows, "a double, b double, c long, d double").repartition(5)


def reference(df, c):
    v = F.col(c)
    if c != "c":
        v = F.when(F.isnan(v), None).otherwise(v)
    return df.select(F.percentile(v.cast("double"), F.array(*[F.lit(p) for p in PROBS]))).first()[0]


@pytest.mark.parametrize("bins,rounds", [(4, 1), (16, 3), (4096, 2)])
def test_equal_to_percentile(frame, bins, rounds):
    got = {(r.column_name, r.p): r.value
           for r in exact_quantiles(frame, ["a", "b", "c", "d"], PROBS, bins=bins, rounds=rounds).collect()}
    for c in "abcd":
        assert [got[(c, p)] for p in PROBS] == reference(frame, c)


def test_median_scalar_and_impute(frame):
    want = frame.select(F.median("b")).first()[0]
    assert frame.select(exact_median(frame, "b")).first()[0] == want
    filled = impute(frame, ["b"], "median").filter("b_imputed").select("b").distinct().collect()
    assert [r.b for r in filled] == [want]


def test_empty_column_gives_no_rows(frame):
    assert exact_quantiles(frame.filter("a > 1e9"), ["a"], [0.5]).count() == 0


def test_no_whole_column_aggregate_in_plan(frame):
    plan = exact_quantiles(frame, ["a"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan


def test_extreme_ranges_and_infinities(spark):
    inf = float("inf")
    rows = [(-inf,), (-1.7e308,), (1.7e308,), (0.0,), (1e-300,), (2e-300,), (inf,), (inf,), (5.0,), (5.0,)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 1 / 9, 3 / 9, 5 / 9, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], probs).collect()}
    values = sorted(v for (v,) in rows)
    assert got == {p: values[round(p * 9)] for p in probs}


def test_largest_shuffle_read_does_not_grow_with_map_tasks(spark):
    """Two-level sketches and bounded histogram rows: rows into the last merge, by input partitions."""
    df = spark.range(40_000).select(F.sqrt("id").alias("v"))

    def merged_rows(parts):
        part = F.pmod(F.spark_partition_id(), F.lit(8))
        return df.repartition(parts).groupBy(part.alias("p")).agg(F.kll_sketch_agg_double("v", 64)).count()

    assert merged_rows(8) == merged_rows(32) == 8
    a, b = (approx_quantiles(df.repartition(n), ["v"], [0.5], ["m"]).first().m for n in (8, 32))
    assert abs(a - b) < 2 and abs(a - 141.4) < 2
