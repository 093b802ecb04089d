"""Filters, validation marks and reason counts."""

from pyspark.sql import functions as F

from staykit.operators import filters, validate
from staykit.plans.listings import REQUIRED_COLUMNS


def listings(spark):
    rows = [
        (1, 37.9, 23.7, "A", "$100.00", 2),
        (2, float("nan"), 23.7, "A", "$20,000.00", 120),
        (3, None, None, None, "", None),
        (4, 37.9, 23.7, "B", None, 90),
        (5, 37.9, 23.7, "B", "abc", 91),
    ]
    return spark.createDataFrame(
        rows, "id long, latitude double, longitude double, property_type string, price string, minimum_nights long")


def test_price_filter_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (20000.0,)], "price double")
    assert filters.keep_price_below(df).count() == 1
    assert filters.count_extreme(df).first().n_extreme == 2       # NaN sorts above numbers


def test_min_nights_drops_null(spark):
    assert [r.id for r in filters.keep_min_nights_at_most(listings(spark)).collect()] == [1, 4]


def test_drop_missing_treats_nan_as_missing(spark):
    kept = filters.drop_missing(listings(spark), REQUIRED_COLUMNS)
    assert sorted(r.id for r in kept.collect()) == [1, 4, 5]


def test_validate_reasons(spark):
    marked = {r.id: (r.reasons, r.is_valid) for r in validate.validate(listings(spark)).collect()}
    assert marked[1] == ("", True)
    assert marked[2] == ("latitude_missing;price_extreme;min_nights_gt_90", False)
    assert marked[3][0] == ("latitude_missing;longitude_missing;property_type_missing;"
                            "minimum_nights_missing;price_unparseable")
    assert marked[4] == ("price_missing", False)
    assert marked[5] == ("price_unparseable;min_nights_gt_90", False)


def test_valid_plus_rejected_is_rows(spark):
    marked = validate.validate(listings(spark))
    assert marked.filter("is_valid").count() + validate.rejected(marked).count() == 5


def test_reason_counts(spark):
    got = {r.reason: r["count"] for r in validate.reason_counts(validate.validate(listings(spark))).collect()}
    assert got["min_nights_gt_90"] == 2
    assert got["price_unparseable"] == 2
    assert "" not in got


def test_custom_rules(spark):
    rules = {"too_many": F.col("minimum_nights") > 100}
    got = [r.reasons for r in validate.validate(listings(spark), rules).orderBy("id").collect()]
    assert got == ["", "too_many", "", "", ""]


def test_isnotnull_pushed_to_parquet(spark, tmp_dir):
    path = tmp_dir + "/l"
    listings(spark).write.parquet(path)
    kept = filters.drop_missing(spark.read.parquet(path), REQUIRED_COLUMNS)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), IsNotNull(property_type)" in plan


def test_text_that_parses_from_another_form_is_marked_loose(spark):
    rows = [("5d", "2020", "40%"), ("$1,234.50", "2020-01-02", "12.5%"), ("Infinity", "2020-01-02 junk", "40"), (None, None, None)]
    df = spark.createDataFrame(rows, "price string, host_since string, host_response_rate string")
    got = [sorted(x for x in r.reasons.split(";") if x.endswith("_loose")) for r in validate.validate(df).select("reasons").collect()]
    assert got == [["host_since_loose", "price_loose"], [], ["host_response_rate_loose", "host_since_loose", "price_loose"], []]
