"""Scalar column builders on tiny frames."""

import datetime as dt
import math

from pyspark.sql import functions as F

from staykit.functions import text as X


def one(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_money_forms(spark):
    vals = ["$1,234.50", "$80,000.00", "", "abc", None]
    assert one(spark, vals, X.money_to_double) == [1234.5, 80000.0, None, None, None]
    assert one(spark, vals, X.money_translate) == [1234.5, 80000.0, None, None, None]


def test_percent_is_not_a_fraction(spark):
    assert one(spark, ["95%", "N/A", "", None, "100%"], X.percent_to_double) == [95.0, None, None, None, 100.0]


def test_tf_to_bool(spark):
    assert one(spark, ["t", "f", "T", None, "x"], X.tf_to_bool) == [True, False, False, None, False]


def test_first_number(spark):
    vals = ["1.5 shared baths", "2-bath", "Half-bath", "10 baths", "", None]
    assert one(spark, vals, X.first_number) == [1.5, 2.0, None, 10.0, None, None]


def test_first_token_and_half_bath(spark):
    vals = ["1 bath", "Half-bath", "Shared half-bath", "", None]
    assert one(spark, vals, X.first_token_number) == [1.0, None, None, None, None]
    half = one(spark, vals, lambda c: X.first_token_number(c, half_bath=0.5))
    assert half == [1.0, 0.5, 0.5, None, None]


def test_dates_never_throw(spark):
    vals = ["2020-01-31", "2020-13-01", "", None]
    assert one(spark, vals, X.safe_to_date) == [dt.date(2020, 1, 31), None, None, None]
    ages = one(spark, vals, lambda c: X.age_days(X.safe_to_date(c), "2020-02-10"))
    assert ages == [10, None, None, None]


def test_null_tokens_and_nan(spark):
    toks = ["", "N/A", "NA", "null", "x", None, "n/a"]
    assert one(spark, toks, X.null_tokens) == [None, None, None, None, "x", None, None]
    out = one(spark, [1.0, float("nan"), None], X.nan_to_null, "v double")
    assert out == [1.0, None, None]


def test_amenities_json_vs_compat(spark):
    bs = chr(92)
    vals = ["[]", '["Coffee, tea"]', '["55' + bs + '" TV", "A ' + bs + 'u2013 B"]', None]
    parsed = one(spark, vals, X.parse_json_list)
    assert parsed == [[], ["Coffee, tea"], ['55" TV', "A – B"], None]
    compat = one(spark, vals, X.split_bracket_list)
    assert compat[0] == [""]
    assert compat[1] == ["Coffee", " tea"]
    assert compat[2] == ["55 TV", " A u2013 B"]
    assert compat[3] is None


def test_is_missing_counts_nan_only_for_floats(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (None, None), (1.0, "a")], "d double, s string")
    got = df.select(X.is_missing("d", df.schema["d"].dataType).alias("a"),
                    X.is_missing("s", df.schema["s"].dataType).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(True, False), (True, True), (False, False)]
    assert not math.isnan(1.0)
