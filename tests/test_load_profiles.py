"""Heavy hitters, drift between loads and mergeable profile states on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staykit.operators import profile_state as S
from staykit.operators.drift import drift_report, ks_statistic, stability
from staykit.operators.heavy_hitters import heavy_hitters
from staykit.operators.profile import profile, top_values

NAN = float("nan")


def frame(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["hot"] * 20 + [None, "b", "c"] + [f"v{j}" for j in range(400)]), rnd.randint(0, 3), None) for i in range(1500)]
    return spark.createDataFrame(rows, "key long, skewed string, few long, gone string")


@pytest.mark.parametrize("k,buckets", [(1, 16), (5, 64), (7, 1 << 16), (2000, 32)])
def test_heavy_hitters_equal_top_values(spark, k, buckets):
    df = frame(spark)
    got, want = heavy_hitters(df, df.columns, k, buckets), top_values(df, df.columns, k)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_heavy_hitters_of_nothing(spark):
    df = frame(spark)
    assert heavy_hitters(df.limit(0), ["key"], 3).collect() == [] and heavy_hitters(df, [], 3).collect() == []


def test_ks_and_stability_equal_a_plain_computation(spark):
    rnd = random.Random(10)
    a = [rnd.choice([rnd.gauss(0, 1), 0.0, -0.0, 2.5, None, NAN]) for _ in range(1200)]
    b = [rnd.choice([rnd.gauss(0.4, 2), 0.0, 2.5]) for _ in range(700)]
    before = spark.createDataFrame([(x, 1.0, None, "t") for x in a], "x double, same double, gone double, t string").repartition(3)
    after = spark.createDataFrame([(x, 1.0, 4.0, 5) for x in b], "x double, same double, gone double, t long")
    av, bv = (np.array([x for x in s if x is not None and x == x]) for s in (a, b))
    grid = np.unique(np.concatenate([av, bv]))
    ks = max(abs((av <= g).mean() - (bv <= g).mean()) for g in grid)
    cuts = sorted(set(np.quantile(av, [i / 10 for i in range(1, 10)]).tolist()))
    ca, cb = (np.bincount(np.searchsorted(cuts, v), minlength=len(cuts) + 1) for v in (av, bv))
    some = (ca > 0) | (cb > 0)
    pa, pb = np.maximum(ca, 0.5)[some] / len(av), np.maximum(cb, 0.5)[some] / len(bv)
    got = {r.column_name: r for r in drift_report(before, after).collect()}
    assert got["x"].ks == pytest.approx(ks) and (got["x"].n_before, got["x"].n_after) == (len(av), len(bv))
    assert got["x"].psi == pytest.approx(float(((pb - pa) * np.log(pb / pa)).sum()), rel=1e-9)
    assert got["same"].ks == 0.0 and got["same"].psi == 0.0
    assert got["gone"].ks is None and got["gone"].psi is None and "t" not in got       # a column without values on one side; one of two types
    assert drift_report(before, before).where("column_name = 'x'").first().ks == 0.0
    assert ks_statistic(before.limit(0), after.limit(0), ["x"]).collect() == [] and stability(before.limit(0), after, ["x"]) == {}


def test_merged_states_equal_the_state_of_the_union(spark, tmp_dir):
    rnd = random.Random(11)
    rows = [(rnd.choice([None, NAN, 0.0, rnd.gauss(1e6, 3)]), rnd.randint(0, 50), rnd.choice(["u", "v", None, f"w{i % 700}"]), i % 3) for i in range(6000)]
    df = spark.createDataFrame(rows, "x double, y long, s string, part int").repartition(5)
    for part in (0, 1, 2, 2):                                           # the last load is kept again
        S.save_state(df.where(F.col("part") == part).drop("part"), f"{tmp_dir}/states", f"l{part}")
    df = df.drop("part")
    merged = {r.column_name: r for r in S.state_report(S.read_states(spark, f"{tmp_dir}/states")).collect()}
    whole = {r.column_name: r for r in S.state_report(S.profile_state(df)).collect()}
    exact = {r.column_name: r for r in profile(df, exact=True).collect()}
    for c in ("x", "y", "s"):
        for name in ("n_rows", "missing_count", "zero_count", "min", "max"):
            assert merged[c][name] == whole[c][name] == exact[c][name], (c, name)
        for name in ("mean", "stddev", "missing_percent"):
            if exact[c][name] is None:
                assert merged[c][name] is None and whole[c][name] is None
            else:
                assert merged[c][name] == pytest.approx(exact[c][name], rel=1e-9) and whole[c][name] == pytest.approx(exact[c][name], rel=1e-9)
        assert abs(merged[c].distinct_count - exact[c].distinct_count) <= 0.03 * exact[c].distinct_count + 1
        assert merged[c].distinct_count == whole[c].distinct_count      # sketches of a union don't depend on how it is cut
    assert merged["y"].p50 == pytest.approx(exact["y"].p50, abs=1) and merged["s"].p50 is None
    empty = S.state_report(S.profile_state(df.limit(0))).collect()
    assert all(r.n_rows in (0, None) and r.mean is None for r in empty)
