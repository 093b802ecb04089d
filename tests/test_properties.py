"""Property tests on random small inputs (hypothesis)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staykit.functions.text import money_to_double, money_translate
from staykit.operators.missing import missing_stats
from staykit.operators.quantiles import exact_quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=20))
def test_money_text_round_trip(spark, cents):
    texts = [f"${c // 100:,}.{c % 100:02d}" for c in cents]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(money_to_double("t").alias("a"), money_translate("t").alias("b")).collect()
    want = [float(t.replace("$", "").replace(",", "")) for t in texts]
    assert [r.a for r in got] == want and [r.b for r in got] == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float)), min_size=1, max_size=60),
       st.sampled_from([10, 100_000]))
def test_exact_quantiles_match_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    present = [v for v in values if v is not None]
    probs = [0.0, 0.3, 0.5, 0.9, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], probs, bins=bins).collect()}
    if not present:
        assert got == {}
        return
    want = np.quantile(np.array(present), probs)
    assert all(abs(got[p] - w) <= 1e-9 * max(1.0, abs(w)) for p, w in zip(probs, want))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32)),
                          st.one_of(st.none(), st.text(max_size=3))), max_size=30))
def test_missing_plus_present_is_rows(spark, rows):
    df = spark.createDataFrame(rows, "x double, s string")
    got = {r.column_name: r.missing_count for r in missing_stats(df).collect()}
    nx = df.filter(F.col("x").isNotNull() & ~F.isnan("x")).count()
    ns = df.filter(F.col("s").isNotNull()).count()
    assert got["x"] + nx == len(rows) and got["s"] + ns == len(rows)
