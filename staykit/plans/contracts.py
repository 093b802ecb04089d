"""Schema contracts for the three listing feeds.

A contract is a ``StructType``; it is stored as its own JSON text
(``StructType.json()``) in the shared folder and read back before a load.
Frames are reconciled with a contract *by name*: columns are picked and
cast by name, absent ones become typed nulls, so file column order never
matters.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ..functions.text import is_floating

# Field names and types of the listings contract, in contract order.
LISTING_FIELDS = [
    ("listing_url", "string"),
    ("scrape_id", "long"),
    ("last_scraped", "string"),
    ("source", "string"),
    ("name", "string"),
    ("description", "string"),
    ("neighborhood_overview", "string"),
    ("picture_url", "string"),
    ("host_id", "long"),
    ("host_url", "string"),
    ("host_name", "string"),
    ("host_since", "string"),
    ("host_location", "string"),
    ("host_about", "string"),
    ("host_response_time", "string"),
    ("host_response_rate", "string"),
    ("host_acceptance_rate", "string"),
    ("host_is_superhost", "string"),
    ("host_thumbnail_url", "string"),
    ("host_picture_url", "string"),
    ("host_neighbourhood", "string"),
    ("host_listings_count", "double"),
    ("host_total_listings_count", "double"),
    ("host_verifications", "string"),
    ("host_has_profile_pic", "string"),
    ("host_identity_verified", "string"),
    ("neighbourhood", "string"),
    ("neighbourhood_cleansed", "string"),
    ("neighbourhood_group_cleansed", "double"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("property_type", "string"),
    ("room_type", "string"),
    ("accommodates", "long"),
    ("bathrooms", "double"),
    ("bathrooms_text", "string"),
    ("bedrooms", "double"),
    ("beds", "double"),
    ("amenities", "string"),
    ("price", "string"),
    ("minimum_nights", "long"),
    ("maximum_nights", "long"),
    ("minimum_minimum_nights", "long"),
    ("maximum_minimum_nights", "long"),
    ("minimum_maximum_nights", "long"),
    ("maximum_maximum_nights", "long"),
    ("minimum_nights_avg_ntm", "double"),
    ("maximum_nights_avg_ntm", "double"),
    ("calendar_updated", "double"),
    ("has_availability", "string"),
    ("availability_30", "long"),
    ("availability_60", "long"),
    ("availability_90", "long"),
    ("availability_365", "long"),
    ("calendar_last_scraped", "string"),
    ("number_of_reviews", "long"),
    ("number_of_reviews_ltm", "long"),
    ("number_of_reviews_l30d", "long"),
    ("first_review", "string"),
    ("last_review", "string"),
    ("review_scores_rating", "double"),
    ("review_scores_accuracy", "double"),
    ("review_scores_cleanliness", "double"),
    ("review_scores_checkin", "double"),
    ("review_scores_communication", "double"),
    ("review_scores_location", "double"),
    ("review_scores_value", "double"),
    ("license", "string"),
    ("instant_bookable", "string"),
    ("calculated_host_listings_count", "long"),
    ("calculated_host_listings_count_entire_homes", "long"),
    ("calculated_host_listings_count_private_rooms", "long"),
    ("calculated_host_listings_count_shared_rooms", "long"),
    ("reviews_per_month", "double"),
]

# The calendar contract, in contract order.
CALENDAR_FIELDS = [
    ("date", "string"),
    ("available", "string"),
    ("price", "string"),
    ("adjusted_price", "string"),
    ("minimum_nights", "long"),
    ("maximum_nights", "long"),
]

# The aggregated-listing contract, in contract order.
AGG_LISTING_FIELDS = [
    ("name", "string"),
    ("host_id", "long"),
    ("host_name", "string"),
    ("neighbourhood_group", "double"),
    ("neighbourhood", "string"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("room_type", "string"),
    ("price", "long"),
    ("minimum_nights", "long"),
    ("number_of_reviews", "long"),
    ("last_review", "string"),
    ("reviews_per_month", "double"),
    ("calculated_host_listings_count", "long"),
    ("availability_365", "long"),
    ("number_of_reviews_ltm", "long"),
    ("license", "string"),
]

_TYPES = {"string": StringType(), "long": LongType(), "double": DoubleType()}


def contract_from_fields(fields: list[tuple[str, str]]) -> StructType:
    return StructType([StructField(n, _TYPES[t], True) for n, t in fields])


LISTING_CONTRACT = contract_from_fields(LISTING_FIELDS)
CALENDAR_CONTRACT = contract_from_fields(CALENDAR_FIELDS)
AGG_LISTING_CONTRACT = contract_from_fields(AGG_LISTING_FIELDS)

CONTRACTS = {
    "listings": LISTING_CONTRACT,
    "calendar": CALENDAR_CONTRACT,
    "agg_listing": AGG_LISTING_CONTRACT,
}

# Columns stamped on every raw row at load time.
METADATA_FIELDS = [
    StructField("processing_datetime", TimestampNTZType(), True),
    StructField("area", StringType(), True),
]


def with_metadata_fields(contract: StructType) -> StructType:
    """Contract plus the load metadata; returns a new struct (argument untouched)."""
    names = set(contract.fieldNames())
    extra = [f for f in METADATA_FIELDS if f.name not in names]
    return StructType(list(contract.fields) + extra)


def save_contract(spark: SparkSession, contract: StructType, path: str) -> str:
    """Write the contract's JSON text to ``path`` (overwriting), via Spark's
    text writer so any Hadoop filesystem works."""
    (spark.createDataFrame([(contract.json(),)], "value string")
     .coalesce(1).write.mode("overwrite").text(path))
    return path


def load_contract(spark: SparkSession, path: str) -> StructType:
    """Read a contract written by :func:`save_contract` (one small text row)."""
    row = spark.read.text(path, wholetext=True).first()
    return StructType.fromJson(json.loads(row[0]))


def apply_contract(df: DataFrame, contract: StructType, keep: list[str] | None = None) -> DataFrame:
    """Select contract fields by name with lenient casts; absent fields -> typed null.

    ``keep`` names extra columns (a key, say) carried in front unchanged.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [F.col(k) for k in keep or []]
    for f in contract.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def schema_report(df: DataFrame, with_counts: bool = True) -> DataFrame:
    """One row per column: ``column_name, data_type, ordinal`` and, with
    ``with_counts``, ``n_values`` (non-null, non-NaN) from a single pass."""
    spark = df.sparkSession
    fields = df.schema.fields
    if not with_counts:
        rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(fields)]
        return spark.createDataFrame(rows, "column_name string, data_type string, ordinal int")
    aggs = [
        F.count_if(F.col(f.name).isNotNull() & ~F.isnan(F.col(f.name)) if is_floating(f.dataType)
                   else F.col(f.name).isNotNull()).alias(f"c{i}")
        for i, f in enumerate(fields)
    ]
    structs = [
        F.struct(F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit(i + 1).alias("ordinal"),
                 F.col(f"c{i}").alias("n_values"))
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def _type_name(dt: DataType | None) -> str | None:
    return None if dt is None else dt.simpleString()


def contract_diff(df: DataFrame, contract: StructType) -> DataFrame:
    """Compare a frame to a contract before writing.

    One row per column of either side: ``column_name, expected_type,
    actual_type, status`` (``match``, ``type_mismatch``, ``missing``,
    ``extra``) and ``bad_values``: for a type mismatch, how many non-null
    values would not survive the cast to the expected type (0 for a match,
    null where the column is absent on one side). One pass over the data.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    order = [f.name for f in contract.fields] + [n for n in have if n not in want]
    aggs, structs = [], []
    for i, name in enumerate(order):
        exp, act = want.get(name), have.get(name)
        if exp is not None and act is not None:
            status = "match" if exp == act else "type_mismatch"
            if status == "match":
                bad = F.lit(0).cast("long")
            else:
                c = F.col(name)
                aggs.append(F.count_if(c.isNotNull() & c.try_cast(exp).isNull()).alias(f"b{i}"))
                bad = F.col(f"b{i}")
        else:
            status = "missing" if act is None else "extra"
            bad = F.lit(None).cast("long")
        structs.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(_type_name(exp)).cast("string").alias("expected_type"),
            F.lit(_type_name(act)).cast("string").alias("actual_type"),
            F.lit(status).alias("status"),
            bad.alias("bad_values"),
        ))
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_n")]
    return df.agg(*aggs).select(F.inline(F.array(*structs)))
