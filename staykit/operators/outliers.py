"""Outliers of single columns: fences and reason codes.

Two kinds of fences, both from exact order statistics of a few passes
(:mod:`.quantiles`), so no task holds a column's values:

* ``mad``: median plus or minus ``width`` robust standard deviations, where
  the deviation is 1.4826 times the median absolute deviation, found by a
  second refinement over ``|v - median|``;
* ``iqr``: the quartiles plus or minus ``width`` interquartile ranges.

A column of which more than half (or the middle half) is one value has no
spread and so no fences; nothing in it is an outlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import _numeric, _round
from .quantiles import _present, empty_report, quantile_values

# The usual widths, and what makes the MAD of a normal distribution its standard deviation.
MAD_WIDTH, IQR_WIDTH, NORMAL = 3.5, 1.5, 1.4826

_FENCES = "column_name string, center double, spread double, low_fence double, high_fence double"


def fences(df: DataFrame, columns: list[str] | None = None, method: str = "mad", width: float | None = None) -> DataFrame:
    """``column_name, center, spread, low_fence, high_fence``, one row a numeric column with a present value.

    ``center`` is the median, ``spread`` the MAD or the interquartile range.
    Runs its passes at once.
    """
    if method not in ("mad", "iqr"):
        raise ValueError(f"unknown kind of fences {method!r}")
    columns = [c for c in (df.columns if columns is None else columns) if _numeric(df, c)]
    width = width if width is not None else MAD_WIDTH if method == "mad" else IQR_WIDTH
    rows = []
    if method == "iqr":
        for c, q in quantile_values(df, columns, [0.25, 0.5, 0.75]).items():
            spread = q[0.75] - q[0.25]
            rows.append((c, q[0.5], spread, *((q[0.25] - width * spread, q[0.75] + width * spread) if spread > 0 else (None, None))))
    else:
        center = {c: q[0.5] for c, q in quantile_values(df, columns, [0.5]).items()}
        away = df.select(*[F.abs(_present(df, c) - F.lit(m)).alias(c) for c, m in center.items()]) if center else df
        for c, q in quantile_values(away, list(center), [0.5]).items():
            reach = width * NORMAL * q[0.5]
            rows.append((c, center[c], q[0.5], *((center[c] - reach, center[c] + reach) if q[0.5] > 0 else (None, None))))
    return df.sparkSession.createDataFrame(rows, _FENCES) if rows else empty_report(df, _FENCES)


def _ends(found: DataFrame) -> list[tuple[str, float, float]]:
    """The fences themselves: a row a column."""
    return [(r["column_name"], r["low_fence"], r["high_fence"]) for r in found.collect() if r["low_fence"] is not None]


def outlier_report(df: DataFrame, columns: list[str] | None = None, method: str = "mad", width: float | None = None,
                   digits: int | None = None) -> DataFrame:
    """:func:`fences` with ``n_values, n_low, n_high`` from one more pass: how many lie below and above."""
    found = fences(df, columns, method, width)
    names = [r["column_name"] for r in found.select("column_name").collect()]
    if not names:
        return empty_report(df, _FENCES + ", n_values bigint, n_low bigint, n_high bigint")
    ends = {c: (low, high) for c, low, high in _ends(found)}
    aggs, structs = [], []
    for i, c in enumerate(names):
        v, (low, high) = _present(df, c), ends.get(c, (None, None))
        none = F.lit(0).cast("long")
        aggs += [F.count(v).alias(f"n{i}"), (F.count_if(v < F.lit(low)) if low is not None else F.max(none)).alias(f"lo{i}"),
                 (F.count_if(v > F.lit(high)) if high is not None else F.max(none)).alias(f"hi{i}")]
        structs.append(F.struct(F.lit(c).alias("_c"), F.col(f"n{i}").alias("n_values"), F.col(f"lo{i}").alias("n_low"), F.col(f"hi{i}").alias("n_high")))
    counts = df.agg(*aggs).select(F.inline(F.array(*structs)))
    out = found.join(counts, F.col("column_name") == F.col("_c")).drop("_c")
    return out.withColumns({c: _round(F.col(c), digits) for c in ("center", "spread", "low_fence", "high_fence")})


def outlier_rules(df: DataFrame, found: DataFrame) -> dict[str, Column]:
    """``<column>_outlier`` rules for :func:`.validate.validate`, one for each column with fences."""
    return {f"{c}_outlier": (_present(df, c) < F.lit(low)) | (_present(df, c) > F.lit(high)) for c, low, high in _ends(found)}
