"""Registered queries: one per operator key of the survey.

Each takes ``(spark, sf_dir)``, reads the driver tables under ``sf_dir``
through the portable fixtures, and returns a lazy DataFrame over the whole
input. Queries that exercise sinks write under the shared folder named by
``spark.checkpoint.dir``, each call into a fresh location, so repeated runs
never see each other's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import (
    areas, clusters, drift, filters, geo, heavy_hitters, impute, missing, missing_patterns, multivariate, outliers, profile, profile_state, validate,
)
from .plans import contracts, listings, sinks
from .plans.ingest import LOAD_ID, ingest_feed, ingest_with_stored_contract, rejects_table, violation_report
from .session import shared_path
from .sources.csv import apply_null_tokens, read_csv_contract, write_csv
from .sources.fixtures import fixture
from .sources.geojson import features_from_docs, read_geojson, read_geojson_rejects, rejected_docs
from .streaming.ingest import rejected, stream_ingest_once

# Fixed parameters of the registered queries (the oracle uses the same).
AS_OF = "2024-01-01"
NOW = "2024-01-01 00:00:00"
AREA = "Athens"
HISTOGRAM_COLUMN, HISTOGRAM_BINS = "review_scores_rating", 10
HISTOGRAM_COLUMNS = ["latitude", "longitude", "accommodates", "bedrooms", "beds", "minimum_nights",
                     "number_of_reviews", "review_scores_rating", "reviews_per_month", "bathrooms"]
TOP_K = 5
TOP_COLUMNS = ["room_type", "property_type", "host_response_time", "host_neighbourhood",
               "minimum_nights", "accommodates"]
MEAN_COLUMNS = ["bedrooms", "beds"]
MEDIAN_COLUMNS = ["bedrooms", "beds", "review_scores_rating"]
ZERO_COLUMNS = ["bedrooms", "beds", "reviews_per_month"]
MODE_COLUMNS = ["host_response_time", "host_neighbourhood", "property_type"]
CATEGORY_COLUMNS = ["host_neighbourhood", "license", "host_response_time"]
PIE_COLUMN = "host_neighbourhood"
STATS_DIGITS = 4
OUTLIER_COLUMNS = ["price", "minimum_nights", "number_of_reviews", "review_scores_rating", "bedrooms", "accommodates"]
UNUSUAL_COLUMNS = ["price", "minimum_nights", "review_scores_rating"]
ASSOCIATED_COLUMNS = ["price", "accommodates", "bedrooms", "minimum_nights", "review_scores_rating", "latitude", "bathrooms"]
ASSOCIATED_TEXT, ASSOCIATED_LEVELS = ["room_type", "property_type", "host_response_time", "host_neighbourhood", "host_since"], 20
GROUP_LEVELS = [["accommodates", "room_type"], ["room_type"], []]
GROUP_MEDIAN_COLUMNS = ["bedrooms", "beds", "review_scores_rating"]
GROUP_MODE_COLUMNS = ["host_response_time", "property_type", "bedrooms"]
GROUP_SUPPORT = 3
HEAVY_COLUMNS = ["minimum_nights", "host_since", "license", "price", "host_neighbourhood", "host_id"]
DRIFT_COLUMNS = ["price", "minimum_nights", "review_scores_rating", "beds", "latitude", "bathrooms"]
AREA_CELL = 0.002
CLUSTER_RADIUS = 6.0
# every fixture column but the all-null ``bathrooms``
ANY_NULL_SUBSET = ["id"] + [c for c in listings.VALIDATED_COLUMNS if c != "bathrooms"]

Query = Callable[[SparkSession, str], DataFrame]


def _listings(spark, sf):
    return fixture(spark, sf, "listings")


def _wide(spark, sf):
    return listings.project(_listings(spark, sf), listings.VALIDATED_COLUMNS)


def _explore(spark, sf):
    return listings.project(_listings(spark, sf), listings.EXPLORE_COLUMNS)


def _fixed_price(spark, sf):
    return _explore(spark, sf).withColumn("price", X.money_translate("price"))


def _pos_prices(spark, sf):
    return filters.keep_price_below(_fixed_price(spark, sf))


def _join_amenities(df):
    return df.withColumn("amenities", F.array_join("amenities", ";"))


def _stage(spark, sf, name):
    """Write a fixture feed as gzip CSV files in a fresh shared folder."""
    return write_csv(fixture(spark, sf, name), shared_path(spark, "staging", name, unique=True))


def _ingest(name: str, key: str | None = None) -> Query:
    def run(spark, sf):
        path = _stage(spark, sf, name)
        table = f"raw_{name}_{shared_path(spark, 'tmp', unique=True).rsplit('/', 1)[1]}"
        return ingest_with_stored_contract(
            spark, shared_path(spark, "contracts", f"{name}.json", unique=True),
            contracts.CONTRACTS[name], path=path, table=table, area=AREA, now=NOW,
            key=key, location=shared_path(spark, "tables", table), missing="allow")
    return run


def q_scan_csv_contract(spark, sf):
    path = _stage(spark, sf, "listings")
    return read_csv_contract(spark, path, contracts.LISTING_CONTRACT, key="id", missing="allow")


def q_ingest_contract_violation(spark, sf):
    return violation_report(spark, _stage(spark, sf, "calendar_dirty"), contracts.CALENDAR_CONTRACT)


def _ingest_dirty(spark, sf):
    table = "raw_dirty_" + shared_path(spark, "tmp", unique=True).rsplit("/", 1)[1]
    ingest_feed(spark, _stage(spark, sf, "calendar_dirty"), contracts.CALENDAR_CONTRACT, table, AREA, NOW,
                location=shared_path(spark, "tables", table), extra=["new_col"], missing=["adjusted_price"])
    return table


def q_ingest_accepted(spark, sf):
    return spark.read.table(_ingest_dirty(spark, sf)).drop(LOAD_ID)


def _reject_rows(rejects):
    raw = F.from_json("raw", "date string, new_col string, minimum_nights string, maximum_nights string")
    return rejects.select("reasons", raw.alias("r"), "area").select("reasons", "r.*", "area")


def q_ingest_rejects(spark, sf):
    return _reject_rows(spark.read.table(rejects_table(_ingest_dirty(spark, sf))))


def q_ingest_retry(spark, sf):
    """One load run twice under its id, between two others: rows of both tables by load."""
    table = "raw_retry_" + shared_path(spark, "tmp", unique=True).rsplit("/", 1)[1]
    path = _stage(spark, sf, "calendar_dirty")
    for load in ("first", "second", "third", "second"):
        ingest_feed(spark, path, contracts.CALENDAR_CONTRACT, table, AREA, NOW, location=shared_path(spark, "tables", table),
                    extra=["new_col"], missing=["adjusted_price"], load_id=load)
    both = [spark.read.table(t).select(LOAD_ID, F.lit(kind).alias("kind")) for t, kind in ((table, "accepted"), (rejects_table(table), "rejected"))]
    return both[0].unionByName(both[1]).groupBy(LOAD_ID, "kind").agg(F.count(F.lit(1)).alias("n_rows"))


def _stream_dirty(spark, sf):
    out = shared_path(spark, "streams", "calendar_dirty", unique=True)
    names = fixture(spark, sf, "calendar_dirty").columns
    good = stream_ingest_once(spark, _stage(spark, sf, "calendar_dirty"), contracts.CALENDAR_CONTRACT, out + "/table", out + "/checkpoint",
                              AREA, NOW, header=names)
    return good, rejected(spark, out + "/table")


def _large_ids(spark, sf):
    base = F.lit(983412345678900000)
    return _listings(spark, sf).select((F.col("id") + base).alias("large_id"), (-F.col("host_id") - base).alias("negative_id"))


def _summary_approx(spark, sf):
    """Exact columns of the sketched summary, and whether its quartiles keep their promise."""
    df = _fixed_price(spark, sf)
    report = profile.summary_long(df, exact=False)
    return _checked(df, report.drop("iqr"))


def _profile_approx(spark, sf):
    df = _fixed_price(spark, sf)
    report = profile.profile(df, exact=False)
    true = profile.distinct_counts(df, df.columns).select(F.col("column_name").alias("_d"), F.col("distinct_count").alias("_n"))
    n = F.coalesce("_n", F.lit(0).cast("long"))
    close = F.abs(F.col("distinct_count") - n) <= 3 * 0.05 * n      # three times HyperLogLog++'s stated error
    report = report.join(F.broadcast(true), F.col("column_name") == F.col("_d"), "left")
    return _checked(df, report.withColumn("distinct_ok", close).drop("_d", "_n", "distinct_count"))


def _checked(df, report):
    ok = profile.rank_checks(df, report).withColumnRenamed("column_name", "_c")
    report = report.join(F.broadcast(ok), F.col("column_name") == F.col("_c"), "left").drop("_c", "p25", "p50", "p75")
    return report.withColumns({c: F.round(c, STATS_DIGITS) for c in ("mean", "stddev", "mean_length") if c in report.columns})


def q_geojson_files(spark, sf):
    """Collections staged as JSON Lines files, read back by the file reader."""
    path = shared_path(spark, "staging", "geojson", unique=True)
    fixture(spark, sf, "geojson_docs").write.text(path)
    return read_geojson(spark, path, multi_line=False)


def q_geojson_file_rejects(spark, sf):
    path = shared_path(spark, "staging", "geojson_dirty", unique=True)
    fixture(spark, sf, "geojson_dirty").write.text(path)
    return read_geojson_rejects(spark, path, multi_line=False)


def q_sink_append_twice(spark, sf):
    path = _stage(spark, sf, "calendar")
    table = "raw_calendar_twice_" + shared_path(spark, "tmp", unique=True).rsplit("/", 1)[1]
    loc = shared_path(spark, "tables", table)
    for _ in range(2):
        t = ingest_feed(spark, path, contracts.CALENDAR_CONTRACT, table, AREA, NOW, location=loc)
    return t.groupBy("available").agg(F.count(F.lit(1)).alias("n_rows"))


def q_stream_ingest_calendar(spark, sf):
    landing = _stage(spark, sf, "calendar")
    out = shared_path(spark, "streams", "calendar", unique=True)
    return stream_ingest_once(spark, landing, contracts.CALENDAR_CONTRACT, out + "/table",
                              out + "/checkpoint", AREA, NOW)


def q_sink_overwrite(spark, sf):
    db_loc = shared_path(spark, "warehouse", "validated.db")
    sinks.ensure_database(spark, "validated", db_loc)
    name = "validated.listings_cleaned_" + shared_path(spark, "tmp", unique=True).rsplit("/", 1)[1]
    sinks.drop_table(spark, name)
    frame = listings.validated_listings(_listings(spark, sf), as_of=AS_OF)
    loc = shared_path(spark, "tables", name.replace(".", "_"))
    sinks.overwrite_table(frame, name, loc)
    sinks.overwrite_table(frame, name, loc)      # overwrite twice: rows not doubled
    return spark.read.table(name)


def q_contract_fields(spark, sf):
    path = contracts.save_contract(spark, contracts.LISTING_CONTRACT,
                                   shared_path(spark, "contracts", "listings.json", unique=True))
    full = contracts.with_metadata_fields(contracts.load_contract(spark, path))
    stamped = sinks.add_metadata_columns(_listings(spark, sf), AREA, NOW)
    return contracts.schema_report(contracts.apply_contract(stamped, full))


def _select_with(df, keep, new: dict):
    return df.select(*keep, *[v.alias(k) for k, v in new.items()])


def _impute_query(method, cols):
    def run(spark, sf):
        df = impute.impute(_listings(spark, sf), cols, method)
        return df.select("id", *cols, *[c + impute.FLAG_SUFFIX for c in cols])
    return run


def _outlier_rows(spark, sf):
    df = _fixed_price(spark, sf)
    return validate.validate(df, outliers.outlier_rules(df, outliers.fences(df, OUTLIER_COLUMNS)))


def _grouped_query(method, cols):
    def run(spark, sf):
        df = impute.impute_grouped(_listings(spark, sf), cols, GROUP_LEVELS, method, support=GROUP_SUPPORT)
        return df.select("id", *[c + x for x in ("", impute.FLAG_SUFFIX, impute.LEVEL_SUFFIX) for c in cols])
    return run


def _after(spark, sf):
    """A later load of the listings: dearer, some for longer stays, the large ones gone."""
    return _fixed_price(spark, sf).where("accommodates <= 12").withColumns({
        "price": F.col("price") * 1.25, "minimum_nights": F.when(F.col("accommodates") > 6, F.col("minimum_nights") + 7).otherwise(F.col("minimum_nights"))})


def _merged_state(spark, sf):
    """A profile from the states of three loads that together are the table."""
    df, folder = _fixed_price(spark, sf), shared_path(spark, "states", unique=True)
    for i, kind in enumerate(("Entire home/apt", "Private room", "Shared room")):
        profile_state.save_state(df.where(F.col("room_type") == kind), folder, f"load{i}")
    report = profile_state.state_report(profile_state.read_states(spark, folder))
    true = profile.distinct_counts(df, df.columns).select(F.col("column_name").alias("_d"), F.col("distinct_count").alias("_n"))
    n = F.coalesce("_n", F.lit(0).cast("long"))
    report = report.join(F.broadcast(true), F.col("column_name") == F.col("_d"), "left")
    return _checked(df, report.withColumn("distinct_ok", F.abs(F.col("distinct_count") - n) <= 3 * 0.008 * n + 1).drop("_d", "_n", "distinct_count"))


def _boundaries(spark, sf):
    return features_from_docs(fixture(spark, sf, "areas"), geometry=True)


def _area_counts(spark, sf):
    points = _fixed_price(spark, sf).select("id", "latitude", "longitude", "price")
    return areas.area_summary(areas.place(points, _boundaries(spark, sf), cell=AREA_CELL), "price", STATS_DIGITS)


def _validated_wide(spark, sf):
    return validate.validate(_wide(spark, sf))


QUERIES: dict[str, Query] = {
    # sources and scans
    "scan_project": lambda s, sf: _explore(s, sf),
    "scan_project_wide": lambda s, sf: _wide(s, sf),
    "null_tokens": lambda s, sf: apply_null_tokens(_listings(s, sf)),
    "scan_csv_contract": q_scan_csv_contract,
    "geojson_features": lambda s, sf: features_from_docs(fixture(s, sf, "geojson_docs")),
    "geojson_files": q_geojson_files,
    "geojson_rejects": lambda s, sf: rejected_docs(fixture(s, sf, "geojson_dirty")),
    "geojson_file_rejects": q_geojson_file_rejects,
    "geojson_boundaries": lambda s, sf: features_from_docs(fixture(s, sf, "geojson_dirty"), geometry=True),
    # contracts, metadata, sinks
    "ingest_contract_violation": q_ingest_contract_violation,
    "ingest_accepted": q_ingest_accepted,
    "ingest_rejects": q_ingest_rejects,
    "ingest_listings": _ingest("listings", key="id"),
    "ingest_calendar": _ingest("calendar"),
    "ingest_agg_listing": _ingest("agg_listing"),
    "ingest_retry": q_ingest_retry,
    "stream_accepted": lambda s, sf: _stream_dirty(s, sf)[0],
    "stream_rejects": lambda s, sf: _reject_rows(_stream_dirty(s, sf)[1]),
    "stream_ingest_calendar": q_stream_ingest_calendar,
    "sink_append_twice": q_sink_append_twice,
    "sink_overwrite": q_sink_overwrite,
    "contract_fields": q_contract_fields,
    "contract_diff": lambda s, sf: contracts.contract_diff(_listings(s, sf), contracts.AGG_LISTING_CONTRACT),
    "metadata_columns": lambda s, sf: sinks.add_metadata_columns(_listings(s, sf), AREA, NOW),
    # scalar functions
    "price_translate": lambda s, sf: _listings(s, sf).select("id", X.money_translate("price").alias("price")),
    "price_regexp": lambda s, sf: _select_with(_listings(s, sf), ["id", "price"],
                                               {"price_clean": X.money_to_double("price")}),
    "percent_clean": lambda s, sf: _select_with(
        _listings(s, sf), ["id", "host_response_rate", "host_acceptance_rate"],
        {"host_response_rate_clean": X.percent_to_double("host_response_rate"),
         "host_acceptance_rate_clean": X.percent_to_double("host_acceptance_rate")}),
    "bool_flags": lambda s, sf: _select_with(
        _listings(s, sf), ["id"],
        {"host_is_superhost_bool": X.tf_to_bool("host_is_superhost"),
         "host_identity_verified_bool": X.tf_to_bool("host_identity_verified"),
         "instant_bookable_bool": X.tf_to_bool("instant_bookable")}),
    "bathrooms_extract": lambda s, sf: _select_with(
        _listings(s, sf), ["id", "bathrooms_text"], {"bathrooms_extracted": X.first_number("bathrooms_text")}),
    "bathrooms_first_token": lambda s, sf: _select_with(
        _listings(s, sf), ["id", "bathrooms_text"], {"bathrooms": X.first_token_number("bathrooms_text")}),
    "bathrooms_half": lambda s, sf: _select_with(
        _listings(s, sf), ["id", "bathrooms_text"],
        {"bathrooms": X.first_token_number("bathrooms_text", half_bath=0.5)}),
    "dates_parsed": lambda s, sf: _select_with(
        _listings(s, sf), ["id"], {c: X.safe_to_date(c) for c in ("host_since", "first_review", "last_review")}),
    "listing_age": lambda s, sf: _select_with(
        _listings(s, sf), ["id"], {"host_since": X.safe_to_date("host_since"),
                                   "listing_age_days": X.age_days(X.safe_to_date("host_since"), AS_OF)}),
    # filters
    "extreme_count": lambda s, sf: filters.count_extreme(_fixed_price(s, sf)),
    "filter_price": lambda s, sf: _pos_prices(s, sf),
    "filter_min_nights": lambda s, sf: filters.keep_min_nights_at_most(_pos_prices(s, sf)),
    "drop_missing": lambda s, sf: filters.drop_missing(_wide(s, sf), listings.REQUIRED_COLUMNS),
    "drop_any_null": lambda s, sf: filters.drop_any_null(_wide(s, sf), ANY_NULL_SUBSET),
    # missing values and imputation
    "fill_constant": lambda s, sf: impute.fill_constant(_wide(s, sf), listings.CONSTANT_FILLS).select(
        "id", *listings.CONSTANT_FILLS, *[c + impute.FLAG_SUFFIX for c in listings.CONSTANT_FILLS]),
    "impute_mean": _impute_query("mean", MEAN_COLUMNS),
    "impute_median": _impute_query("median", MEDIAN_COLUMNS),
    "impute_zero": _impute_query("zero", ZERO_COLUMNS),
    "impute_mode": _impute_query("mode", MODE_COLUMNS),
    "impute_category": _impute_query("category", CATEGORY_COLUMNS),
    "impute_grouped_median": _grouped_query("median", GROUP_MEDIAN_COLUMNS),
    "impute_grouped_mode": _grouped_query("mode", GROUP_MODE_COLUMNS),
    # validation
    "outlier_report": lambda s, sf: outliers.outlier_report(_fixed_price(s, sf), OUTLIER_COLUMNS, digits=STATS_DIGITS),
    "outlier_report_iqr": lambda s, sf: outliers.outlier_report(_fixed_price(s, sf), OUTLIER_COLUMNS, "iqr", digits=STATS_DIGITS),
    "validate_outliers": lambda s, sf: _outlier_rows(s, sf).select("id", "reasons", "is_valid"),
    "unusual_rows": lambda s, sf: multivariate.unusual_rows(_fixed_price(s, sf), UNUSUAL_COLUMNS, digits=3).select(
        "id", "distance2", "is_unusual"),
    "validate_rows": lambda s, sf: _validated_wide(s, sf).select("id", "reasons", "is_valid"),
    "validate_reason_counts": lambda s, sf: validate.reason_counts(_validated_wide(s, sf)),
    # missing-value reports
    "missing_stats": lambda s, sf: missing.missing_stats(_wide(s, sf).drop("id")),
    "missing_stats_empty": lambda s, sf: missing.missing_stats(
        _wide(s, sf).drop("id").filter(F.col("accommodates") > 16)),
    "missing_bar": lambda s, sf: missing.missing_bar(missing.missing_stats(_wide(s, sf).drop("id"))),
    "missing_pie": lambda s, sf: missing.missing_pie(_wide(s, sf), PIE_COLUMN),
    "missing_patterns": lambda s, sf: missing_patterns.missing_patterns(_wide(s, sf).drop("id")),
    "co_missing": lambda s, sf: missing_patterns.co_missing(_wide(s, sf).drop("id"), digits=STATS_DIGITS),
    "missing_effect": lambda s, sf: missing_patterns.missing_effect(_fixed_price(s, sf).drop("id"), "price", digits=STATS_DIGITS),
    # profiles
    "numeric_association": lambda s, sf: multivariate.numeric_association(_fixed_price(s, sf), ASSOCIATED_COLUMNS, digits=STATS_DIGITS),
    "text_association": lambda s, sf: multivariate.text_association(
        _listings(s, sf), ASSOCIATED_TEXT, ASSOCIATED_LEVELS, digits=STATS_DIGITS),
    "heavy_hitters": lambda s, sf: heavy_hitters.heavy_hitters(_listings(s, sf), HEAVY_COLUMNS, TOP_K),
    "drift_report": lambda s, sf: drift.drift_report(_fixed_price(s, sf), _after(s, sf), DRIFT_COLUMNS, digits=STATS_DIGITS),
    "profile_state": _merged_state,
    "value_counts": lambda s, sf: profile.value_counts(_pos_prices(s, sf), "minimum_nights"),
    "top_values": lambda s, sf: profile.top_values(_wide(s, sf), TOP_COLUMNS, TOP_K),
    "describe_long": lambda s, sf: profile.describe_long(_fixed_price(s, sf), digits=STATS_DIGITS),
    "describe_keep_nan": lambda s, sf: profile.describe_long(
        _fixed_price(s, sf).select("latitude", "longitude", "price"), nan_as_missing=False, digits=STATS_DIGITS),
    "describe_price": lambda s, sf: profile.describe_long(_fixed_price(s, sf).select("price"),
                                                          digits=STATS_DIGITS),
    "describe_min_nights": lambda s, sf: profile.describe_long(
        _pos_prices(s, sf).select("minimum_nights"), digits=STATS_DIGITS),
    "describe_large_ids": lambda s, sf: profile.describe_long(_large_ids(s, sf)).select(
        "column_name", "count", "min_text", "max_text"),
    "summary_exact": lambda s, sf: profile.summary_long(_fixed_price(s, sf), exact=True, digits=STATS_DIGITS),
    "summary_approx": _summary_approx,
    "profile_exact": lambda s, sf: profile.profile(_fixed_price(s, sf), exact=True, digits=STATS_DIGITS),
    "profile_approx": _profile_approx,
    "histogram": lambda s, sf: profile.histogram(_listings(s, sf), HISTOGRAM_COLUMN, HISTOGRAM_BINS),
    "histograms": lambda s, sf: profile.histograms(_listings(s, sf), HISTOGRAM_COLUMNS, HISTOGRAM_BINS),
    "amenity_counts": lambda s, sf: listings.amenity_counts(_listings(s, sf), "json"),
    "amenity_counts_compat": lambda s, sf: listings.amenity_counts(_listings(s, sf), "compat"),
    # map frames
    "map_points": lambda s, sf: geo.map_points(_listings(s, sf)),
    "cluster_points": lambda s, sf: geo.cluster_points(_listings(s, sf)),
    "off_earth": lambda s, sf: geo.off_earth(_listings(s, sf)).select("id", "latitude", "longitude"),
    "listing_areas": lambda s, sf: areas.areas_of(_listings(s, sf), _boundaries(s, sf), cell=AREA_CELL),
    "area_counts": _area_counts,
    "boundary_rejects": lambda s, sf: areas.boundary_rejects(_boundaries(s, sf)),
    "distance_clusters": lambda s, sf: clusters.distance_clusters(_listings(s, sf), radius=CLUSTER_RADIUS),
    "tile_pyramid": lambda s, sf: clusters.tile_pyramid(_listings(s, sf)),
    # pipelines
    "clean_listings": lambda s, sf: _join_amenities(listings.clean_listings(_listings(s, sf))),
    "clean_listings_compat": lambda s, sf: _join_amenities(
        listings.clean_listings(_listings(s, sf), amenities="compat")),
    "prepare_listings": lambda s, sf: _join_amenities(listings.prepare_listings(_listings(s, sf))),
    "validated_listings": lambda s, sf: listings.validated_listings(_listings(s, sf), as_of=AS_OF),
    "validated_listings_filled": lambda s, sf: listings.validated_listings(
        _listings(s, sf), as_of=AS_OF, fill=True),
}
