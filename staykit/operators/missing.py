"""Missing-value statistics and chart frames (A2-A4).

``missing_stats`` is one aggregate over the whole frame: every column's
missing count is a ``count_if`` in the same pass, partial aggregates are
combined map-side, and the single wide row is unpivoted in place. Nothing
is collected to the driver, and an empty input gives a null percent rather
than a division error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing
from .quantiles import empty_report


def missing_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_name, missing_count, missing_percent`` ordered by percent desc.

    NaN counts as missing in ``double``/``float`` columns; the percent is
    ``missing_count / rows * 100`` and null when there are no rows.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not fields:
        return empty_report(df, "column_name string, missing_count bigint, missing_percent double")
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(is_missing(f.name, f.dataType)).alias(f"m{i}") for i, f in enumerate(fields)
    ]
    pairs = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"m{i}").alias("missing_count"))
        for i, f in enumerate(fields)
    ])
    return (df.agg(*aggs)
            .select("_rows", F.inline(pairs))
            .select("column_name", "missing_count",
                    (F.col("missing_count") / F.nullif(F.col("_rows"), F.lit(0)) * 100)
                    .alias("missing_percent"))
            .orderBy(F.col("missing_percent").desc(), F.col("column_name")))


def missing_bar(stats: DataFrame) -> DataFrame:
    """Bar-chart frame: columns missing some but not all values."""
    pct = F.col("missing_percent")
    return stats.filter((pct > 0) & (pct < 100))


def missing_pie(df: DataFrame, column: str) -> DataFrame:
    """Pie-chart frame: ``status`` (``Missing`` / ``Not Missing``) and ``count``."""
    dtype = df.schema[column].dataType
    status = F.when(is_missing(column, dtype), F.lit("Missing")).otherwise(F.lit("Not Missing"))
    return df.groupBy(status.alias("status")).count()
