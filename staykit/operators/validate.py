"""Row validation with reasons.

Each rule is a named boolean Column; a row's ``reasons`` is the ``;``-joined
list of the rules it breaks (``concat_ws`` skips the nulls of rules that
hold), ``is_valid`` is true when the list is empty. Marking keeps every row;
``rejected`` and ``reason_counts`` are what the marks are for. All of it is
one narrow projection, plus one hash aggregate for the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    first_number,
    is_missing,
    money_to_double,
    percent_to_double,
    safe_to_date,
)
from .filters import EXTREME_PRICE, MAX_MINIMUM_NIGHTS

REASON_SEP = ";"
# The text forms the feeds use; a value that parses from another
# form (``2020`` as a date, ``5d`` or ``Infinity`` as a price) is marked loose.
STRICT_FORMS = {
    "price": "[$]?[0-9][0-9,]*([.][0-9]+)?",
    "host_response_rate": "[0-9]+([.][0-9]+)?%",
    "host_acceptance_rate": "[0-9]+([.][0-9]+)?%",
    "host_since": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "first_review": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "last_review": "[0-9]{4}-[0-9]{2}-[0-9]{2}",
}


def _unparseable(raw: Column, parsed: Column) -> Column:
    return raw.isNotNull() & parsed.isNull()


def listing_rules(df: DataFrame, price_parsed: str | None = None) -> dict[str, Column]:
    """Default rules for raw listing rows; only those whose columns exist.

    Missing: the three fields rows are dropped for (coordinates, property
    type) and the two the exploratory filters drop on null (price, minimum
    nights). Unparseable: text that a cleaning step turns into null. Loose:
    text that parses but not from the feed's form. Range:
    the two thresholds the reference filters on. ``price_parsed`` names an
    already-cleaned price column; otherwise the raw text is parsed here.
    """
    have = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    rules: dict[str, Column] = {}
    for c in ("latitude", "longitude", "property_type", "price", "minimum_nights"):
        if c in have:
            rules[f"{c}_missing"] = is_missing(c, types[c])
    parsers = {
        "price": money_to_double,
        "host_response_rate": percent_to_double,
        "host_acceptance_rate": percent_to_double,
        "host_since": safe_to_date,
        "first_review": safe_to_date,
        "last_review": safe_to_date,
        "bathrooms_text": first_number,
    }
    for c, parse in parsers.items():
        if c in have and str(types[c].simpleString()) == "string":
            rules[f"{c}_unparseable"] = _unparseable(F.col(c), parse(c))
            if c in STRICT_FORMS:
                rules[f"{c}_loose"] = parse(c).isNotNull() & ~F.col(c).rlike(f"^(?:{STRICT_FORMS[c]})$")
    price = F.col(price_parsed) if price_parsed else (
        money_to_double("price") if "price" in have and types["price"].simpleString() == "string"
        else (F.col("price") if "price" in have else None))
    if price is not None:
        rules["price_extreme"] = price >= EXTREME_PRICE
    if "minimum_nights" in have:
        rules["min_nights_gt_90"] = F.col("minimum_nights") > MAX_MINIMUM_NIGHTS
    return rules


def validate(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``reasons`` (text, rule names joined by ``;``) and ``is_valid``."""
    rules = listing_rules(df) if rules is None else rules
    marks = [F.when(cond, F.lit(name)) for name, cond in rules.items()]
    reasons = F.concat_ws(REASON_SEP, *marks) if marks else F.lit("")
    return df.withColumn("reasons", reasons).withColumn("is_valid", F.col("reasons") == "")


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("is_valid"))


def reason_counts(marked: DataFrame) -> DataFrame:
    """``reason, count`` over rejected rows (a row counts once per reason).

    Valid rows carry an empty list, so exploding every row and dropping the
    empty item counts rejected rows only. Filtering on ``is_valid`` first
    would be pushed below the projection and evaluate every rule twice.
    """
    return (marked
            .select(F.explode(F.split(F.col("reasons"), REASON_SEP)).alias("reason"))
            .filter(F.col("reason") != "")
            .groupBy("reason").count()
            .orderBy(F.col("count").desc(), F.col("reason")))
