"""Row filters.

Predicates are plain comparisons so Catalyst merges consecutive filters
and pushes what it can into the parquet scan (``IsNotNull``, comparisons on
stored columns). ``dropna`` is written out as ``isNotNull & ~isnan``
because Spark does not push ``AtLeastNNonNulls``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_present

# Thresholds the reference filters on.
EXTREME_PRICE = 10000
MAX_MINIMUM_NIGHTS = 90


def count_where(df: DataFrame, condition, alias: str = "n_rows") -> DataFrame:
    """One-row count of rows meeting ``condition`` (partial counts per task)."""
    return df.filter(condition).agg(F.count(F.lit(1)).alias(alias))


def count_extreme(df: DataFrame, price_col: str = "price", limit: float = EXTREME_PRICE) -> DataFrame:
    return count_where(df, F.col(price_col) >= limit, "n_extreme")


def keep_price_below(df: DataFrame, price_col: str = "price", limit: float = EXTREME_PRICE) -> DataFrame:
    """Rows with ``price < limit``; null and NaN prices are dropped too."""
    return df.filter(F.col(price_col) < limit)


def keep_min_nights_at_most(df: DataFrame, limit: int = MAX_MINIMUM_NIGHTS,
                            col: str = "minimum_nights") -> DataFrame:
    return df.filter(F.col(col) <= limit)


def drop_missing(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows where any of ``subset`` is null (or NaN for floating columns)."""
    cond = F.lit(True)
    for c in subset:
        cond = cond & is_present(c, df.schema[c].dataType)
    return df.filter(cond)


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any missing value over ``subset`` (default: all columns)."""
    return drop_missing(df, subset or df.columns)
