"""Listing preparation flows (L1-L4, L6), each a chain of DataFrame steps.

Every flow is narrow (no shuffle) except the amenity frequencies: one stage
from the scan to the sink, with the column subset pruned into the parquet
read and the coordinate filter pushed down as ``IsNotNull``. Derived
columns are added with one ``withColumns`` per step, so the analyzed plan
stays small however many columns a step touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    age_days,
    first_number,
    first_token_number,
    money_to_double,
    money_translate,
    parse_json_list,
    percent_to_double,
    safe_to_date,
    split_bracket_list,
    tf_to_bool,
)
from ..operators.filters import drop_missing, keep_min_nights_at_most, keep_price_below
from ..operators.impute import fill_constant
from ..operators.validate import listing_rules, validate

# The 21 columns the exploratory notebook keeps, in its order.
EXPLORE_COLUMNS = [
    "host_id", "host_since", "host_is_superhost", "latitude", "longitude", "property_type",
    "room_type", "accommodates", "bathrooms", "bathrooms_text", "bedrooms", "beds", "amenities",
    "price", "minimum_nights", "maximum_nights", "number_of_reviews", "review_scores_rating",
    "license", "instant_bookable", "reviews_per_month",
]

# The 34 columns the validated-listings notebook keeps, in its order.
VALIDATED_COLUMNS = [
    "host_id", "host_since", "host_is_superhost", "host_response_time",
    "host_response_rate", "host_acceptance_rate", "host_neighbourhood",
    "host_listings_count", "host_identity_verified",
    "latitude", "longitude", "property_type", "room_type", "accommodates",
    "bathrooms", "bathrooms_text", "bedrooms", "beds", "amenities", "price",
    "minimum_nights", "maximum_nights", "number_of_reviews",
    "first_review", "last_review", "review_scores_rating",
    "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location",
    "review_scores_value", "license", "instant_bookable", "reviews_per_month",
]

# Required fields, and the constant fills of the first validated version.
REQUIRED_COLUMNS = ["latitude", "longitude", "property_type"]
CONSTANT_FILLS = {"bathrooms": 0, "bedrooms": 0, "beds": 0, "reviews_per_month": 0}


def project(df: DataFrame, columns: list[str], key: str | None = "id") -> DataFrame:
    """Keep-list projection; the key (when present) stays in front."""
    keep = ([key] if key and key in df.columns else []) + columns
    return df.select(*keep)


def parse_amenities(mode: str = "json"):
    return parse_json_list if mode == "json" else split_bracket_list


def clean_listings(raw: DataFrame, key: str | None = "id", amenities: str = "json",
                   half_bath: float | None = None) -> DataFrame:
    """Exploratory clean: 21 columns, price to double, drop extreme prices and
    stays over 90 nights, bathrooms from the first token (``bathrooms_text``
    dropped), ``t``/``f`` flags to boolean, amenities to an array."""
    df = project(raw, EXPLORE_COLUMNS, key)
    df = df.withColumn("price", money_translate("price"))
    df = keep_min_nights_at_most(keep_price_below(df))
    df = (df.withColumn("bathrooms", first_token_number("bathrooms_text", half_bath))
          .drop("bathrooms_text"))
    df = df.withColumns({"instant_bookable": tf_to_bool("instant_bookable"),
                         "host_is_superhost": tf_to_bool("host_is_superhost")})
    return df.withColumn("amenities", parse_amenities(amenities)("amenities"))


def prepare_listings(raw: DataFrame, key: str | None = "id", amenities: str = "json",
                     half_bath: float | None = None) -> DataFrame:
    """All exploratory steps combined, with validation instead of deletion:
    every row is kept and carries ``reasons`` / ``is_valid`` computed on the
    raw text before it is cleaned."""
    df = project(raw, EXPLORE_COLUMNS, key)
    df = validate(df, listing_rules(df))
    df = df.withColumns({
        "price": money_translate("price"),
        "bathrooms": first_token_number("bathrooms_text", half_bath),
        "instant_bookable": tf_to_bool("instant_bookable"),
        "host_is_superhost": tf_to_bool("host_is_superhost"),
        "amenities": parse_amenities(amenities)("amenities"),
    })
    return df.drop("bathrooms_text")


def validated_listings(raw: DataFrame, as_of=None, fill: bool = False,
                       key: str | None = "id") -> DataFrame:
    """The validated table: 34 columns plus 8 derived ones.

    Adds cleaned price and rates, boolean flags, parsed dates (in place),
    ``listing_age_days`` (to ``as_of``, default today) and the first number
    of ``bathrooms_text``; drops rows without coordinates or property type.
    ``fill`` applies the first version's constant fills (with flags).
    """
    df = project(raw, VALIDATED_COLUMNS, key)
    df = df.withColumns({
        "price_clean": money_to_double("price"),
        "host_response_rate_clean": percent_to_double("host_response_rate"),
        "host_acceptance_rate_clean": percent_to_double("host_acceptance_rate"),
    })
    df = drop_missing(df, REQUIRED_COLUMNS)
    if fill:
        df = fill_constant(df, CONSTANT_FILLS)
    df = df.withColumns({
        "host_is_superhost_bool": tf_to_bool("host_is_superhost"),
        "host_identity_verified_bool": tf_to_bool("host_identity_verified"),
        "instant_bookable_bool": tf_to_bool("instant_bookable"),
        "host_since": safe_to_date("host_since"),
        "first_review": safe_to_date("first_review"),
        "last_review": safe_to_date("last_review"),
    })
    return df.withColumns({
        "listing_age_days": age_days("host_since", as_of),
        "bathrooms_extracted": first_number("bathrooms_text"),
    })


def amenity_counts(df: DataFrame, mode: str = "json") -> DataFrame:
    """``item, count`` of lower-cased amenities, rarest first (ties by item).

    ``json`` parses the list as JSON (escaped quotes and commas inside an
    item survive); ``compat`` is the reference's strip-and-split.
    """
    items = df.select(F.explode(parse_amenities(mode)("amenities")).alias("item"))
    return (items.select(F.lower("item").alias("item"))
            .groupBy("item").count()
            .orderBy(F.col("count"), F.col("item")))
