"""Column profiles: frequencies, describe / summary, data profile, histogram
(A5-A12, O1).

Each report is a single aggregate pass whose one wide row is unpivoted into
typed long rows (``inline`` of an array of structs) instead of Spark's
all-string ``describe()`` frame. Frequency reports are hash aggregates with
map-side partial counts, so a value held by a third of all rows costs one
partial row per task, not a hot reducer.

Scale notes: ``approx`` quantiles (KLL) merge on two levels, so no task reads
every map task's sketch, and distinct counts (HyperLogLog++) are fixed-size.
``exact=True`` computes quantiles by the refinement of :mod:`.quantiles` and
distinct counts with a stacked distributed dedupe; neither ever holds a whole
column's distinct values in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegralType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.text import is_floating, is_missing, is_present
from .quantiles import RANK_ERROR, _stack, approx_quantiles, empty_report, exact_quantile_columns

QUARTILES = [0.25, 0.5, 0.75]


def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NumericType)


def _text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


def _integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, IntegralType)


def _value(df: DataFrame, c: str, nan_as_missing: bool = True) -> Column:
    """Column value with NaN read as missing (floating columns only)."""
    col = F.col(c)
    if nan_as_missing and is_floating(df.schema[c].dataType):
        return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)
    return col


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table ``<column>, count``; null is a group; most frequent first."""
    return (df.groupBy(column).count()
            .orderBy(F.col("count").desc(), F.col(column).asc_nulls_first()))


def top_values(df: DataFrame, columns: list[str], k: int = 5, skip_missing: bool = False) -> DataFrame:
    """The ``k`` most frequent values of each column, ties broken by value.

    ``column_name, value (text), count, rank``; null is a value unless
    ``skip_missing``. All columns share one scan and
    one aggregate; the per-column top-k is a ``row_number`` filter that Spark
    plans with a partial ``WindowGroupLimit`` before the shuffle, so at most
    ``k`` rows per column leave each task.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ])
    values = df.select(F.inline(pairs))
    if skip_missing:
        values = values.where(F.col("value").isNotNull())
    counts = values.groupBy("column_name", "value").count()
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return (counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("column_name", "value", "count", F.col("rank").cast("long").alias("rank")))


def describable(df: DataFrame) -> list[str]:
    """Columns ``describe()`` reports on: numeric and text (not boolean/date)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, StringType))
            and not isinstance(f.dataType, (BooleanType, DateType, TimestampType, TimestampNTZType))]


def describe_long(df: DataFrame, columns: list[str] | None = None,
                  nan_as_missing: bool = True, digits: int | None = None) -> DataFrame:
    """``describe()`` as typed long rows, one aggregate pass.

    ``column_name, count, mean, stddev, min, max, min_text, max_text``:
    numeric columns fill ``mean``/``stddev`` (sample)/``min``/``max``; text
    columns fill ``min_text``/``max_text``, and so do integral ones, exactly
    (a double holds no integer above 2^53). NaN is read as missing unless
    ``nan_as_missing`` is false (then it spreads into mean and max, as in
    Spark's ``describe``).
    """
    cols = [c for c in (describable(df) if columns is None else columns) if _numeric(df, c) or _text(df, c)]
    if not cols:
        return empty_report(df, "column_name string, count bigint, mean double, stddev double, "
                                "min double, max double, min_text string, max_text string")
    aggs, structs = [], []
    for i, c in enumerate(cols):
        v = _value(df, c, nan_as_missing)
        num = _numeric(df, c)
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if num:
            aggs += [F.avg(v).alias(f"mu{i}"), F.stddev_samp(v).alias(f"sd{i}")]
        none_d = F.lit(None).cast("double")
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("count"),
            (_round(F.col(f"mu{i}"), digits) if num else none_d).alias("mean"),
            (_round(F.col(f"sd{i}"), digits) if num else none_d).alias("stddev"),
            (F.col(f"lo{i}").cast("double") if num else none_d).alias("min"),
            (F.col(f"hi{i}").cast("double") if num else none_d).alias("max"),
            _extreme_text(df, c, f"lo{i}").alias("min_text"),
            _extreme_text(df, c, f"hi{i}").alias("max_text"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def _extreme_text(df: DataFrame, c: str, name: str) -> Column:
    """An extreme as text: of text and integral columns, else null."""
    return F.col(name).cast("string") if _text(df, c) or _integral(df, c) else F.lit(None).cast("string")


_SUMMARY = ("column_name string, count bigint, mean double, stddev double, min double, max double, "
            "min_text string, max_text string, p25 double, p50 double, p75 double, iqr double")


def summary_long(df: DataFrame, columns: list[str] | None = None, exact: bool = False,
                 digits: int | None = None) -> DataFrame:
    """``summary()`` as typed rows: :func:`describe_long` plus quartiles and IQR.

    ``column_name, count, mean, stddev, min, max, min_text, max_text, p25,
    p50, p75, iqr``; text columns have count, ``min_text`` and ``max_text``.
    Quartiles are sketched, or with ``exact`` equal to ``percentile``; both
    come joined on the column name (one row per column on each side).
    """
    cols = [c for c in (describable(df) if columns is None else columns) if _numeric(df, c) or _text(df, c)]
    if not cols:
        return empty_report(df, _SUMMARY)
    stats = _with_quartiles(describe_long(df, cols, digits=digits), df, cols, exact)
    return stats.withColumn("iqr", _round(F.col("p75") - F.col("p25"), digits)).withColumns(
        {n: _round(F.col(n), digits) for n in ("p25", "p50", "p75")})


def _with_quartiles(stats: DataFrame, df: DataFrame, cols: list[str], exact: bool) -> DataFrame:
    """Add p25, p50, p75 of the numeric columns (one row per column on both sides)."""
    names = ["p25", "p50", "p75"]
    numeric = [c for c in cols if _numeric(df, c)]
    if not numeric:
        return stats.withColumns({n: F.lit(None).cast("double") for n in names})
    q = (exact_quantile_columns if exact else approx_quantiles)(df, numeric, QUARTILES, names)
    q = q.withColumnRenamed("column_name", "_c")
    return stats.join(F.broadcast(q), F.col("column_name") == F.col("_c"), "left").drop("_c")


def rank_checks(df: DataFrame, report: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """``column_name, p25_ok, p50_ok, p75_ok``: whether a report's quartiles have
    their rank within ``error`` (a share of the values) of the true one."""
    names = ["p25", "p50", "p75"]
    columns = [c for c in df.columns if _numeric(df, c)]
    q = report.select(F.col("column_name").alias("_c"), *names)
    joined = _stack(df, columns).join(F.broadcast(q), F.col("column_name") == F.col("_c"))   # one row per column
    counts = joined.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"), *[
        c for n in names for c in (F.count_if(F.col("v") < F.col(n)).alias(f"{n}_lt"), F.count_if(F.col("v") <= F.col(n)).alias(f"{n}_le"))])
    return counts.select("column_name", *[
        ((F.col(f"{n}_lt") <= (p + error) * F.col("n")) & (F.col(f"{n}_le") >= (p - error) * F.col("n"))).alias(f"{n}_ok")
        for n, p in zip(names, QUARTILES)])


def typed_stack(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, s, d, i``: every present value of ``columns`` stacked,
    in a slot of its own type (text, floating, integral), so values of
    different columns never collide and keep their own order."""
    def slot(c: str):
        v = _value(df, c)
        dt = df.schema[c].dataType
        integral = isinstance(dt, NumericType) and not is_floating(dt) and dt.typeName() != "decimal"
        s = F.lit(None).cast("string")
        d = F.lit(None).cast("double")
        i = F.lit(None).cast("long")
        if integral:
            i = v.cast("long")
        elif is_floating(dt):
            d = v.cast("double")
        else:
            s = v.cast("string")
        return F.struct(F.lit(c).alias("column_name"), s.alias("s"), d.alias("d"), i.alias("i"))

    stacked = df.select(F.inline(F.array(*[slot(c) for c in columns])))
    return stacked.filter(F.col("s").isNotNull() | F.col("d").isNotNull() | F.col("i").isNotNull())


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact ``column_name, distinct_count`` (missing values skipped).

    One distributed dedupe of the typed stack (partial per task, so a hot
    value is one row per task) and a count per column. This shuffles about
    the same bytes as Spark's rewrite of many ``count(distinct)``, without
    dragging every other aggregate through the ``Expand``.
    """
    return (typed_stack(df, columns).distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))


_PROFILE = ("column_name string, data_type string, n_rows bigint, missing_count bigint, missing_percent double, "
            "distinct_count bigint, zero_count bigint, mean double, stddev double, min double, max double, min_text string, "
            "max_text string, min_length bigint, max_length bigint, mean_length double, top_value string, top_count bigint, "
            "p25 double, p50 double, p75 double")


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False,
            digits: int | None = None) -> DataFrame:
    """Data profile of every column.

    ``column_name, data_type, n_rows, missing_count, missing_percent,
    distinct_count, zero_count, mean, stddev, min, max, min_text, max_text,
    min_length, max_length, mean_length, top_value, top_count, p25, p50,
    p75``. Numeric statistics are null for other columns; ``min_text`` and
    ``max_text`` are filled for text and, exactly, for integral columns;
    lengths, the most frequent value (lowest on ties) and its count for text.
    Missing counts treat NaN as missing; distinct counts skip missing values.
    Quartiles, distinct counts and top values are joined on the column name
    (one row per column on each side).
    """
    cols = df.columns if columns is None else columns
    if not cols:
        return empty_report(df, _PROFILE)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    structs = []
    none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("long")
    for i, c in enumerate(cols):
        dtype = df.schema[c].dataType
        v = _value(df, c)
        num, text = _numeric(df, c), _text(df, c)
        aggs.append(F.count_if(is_missing(c, dtype)).alias(f"m{i}"))
        if not exact:
            aggs.append(F.approx_count_distinct(v).alias(f"d{i}"))
        if num or text:
            aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if num:
            vd = v.cast("double")
            aggs += [F.count_if(vd == 0).alias(f"z{i}"), F.avg(vd).alias(f"mu{i}"), F.stddev_samp(vd).alias(f"sd{i}")]
        if text:
            aggs += [F.min(F.char_length(v)).alias(f"sl{i}"), F.max(F.char_length(v)).alias(f"ll{i}"),
                     F.avg(F.char_length(v)).alias(f"al{i}")]
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(dtype.simpleString()).alias("data_type"),
            F.col("_rows").alias("n_rows"),
            F.col(f"m{i}").alias("missing_count"),
            (F.col(f"m{i}") / F.nullif(F.col("_rows"), F.lit(0)) * 100).alias("missing_percent"),
            (none_l if exact else F.col(f"d{i}").cast("long")).alias("distinct_count"),
            (F.col(f"z{i}") if num else none_l).alias("zero_count"),
            (_round(F.col(f"mu{i}"), digits) if num else none_d).alias("mean"),
            (_round(F.col(f"sd{i}"), digits) if num else none_d).alias("stddev"),
            (F.col(f"lo{i}").cast("double") if num else none_d).alias("min"),
            (F.col(f"hi{i}").cast("double") if num else none_d).alias("max"),
            _extreme_text(df, c, f"lo{i}").alias("min_text"),
            _extreme_text(df, c, f"hi{i}").alias("max_text"),
            (F.col(f"sl{i}").cast("long") if text else none_l).alias("min_length"),
            (F.col(f"ll{i}").cast("long") if text else none_l).alias("max_length"),
            (_round(F.col(f"al{i}"), digits) if text else none_d).alias("mean_length"),
        ))
    stats = df.agg(*aggs).select(F.inline(F.array(*structs)))
    stats = _with_quartiles(stats, df, cols, exact).withColumns({n: _round(F.col(n), digits) for n in ("p25", "p50", "p75")})
    texts = [c for c in cols if _text(df, c)]
    if texts:
        top = top_values(df, texts, 1, skip_missing=True).select(
            F.col("column_name").alias("_t"), F.col("value").alias("top_value"), F.col("count").alias("top_count"))
        stats = stats.join(F.broadcast(top), F.col("column_name") == F.col("_t"), "left")
    else:
        stats = stats.withColumns({"top_value": F.lit(None).cast("string"), "top_count": none_l})
    if exact:
        counts = distinct_counts(df, cols).select(F.col("column_name").alias("_d"), F.col("distinct_count").alias("_dc"))
        stats = stats.join(F.broadcast(counts), F.col("column_name") == F.col("_d"), "left").withColumn(
            "distinct_count", F.coalesce("_dc", F.lit(0).cast("long")))
    return stats.select(*[x.split()[0] for x in _PROFILE.split(", ")])


def histograms(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Equal-width histograms of numeric columns, each over its own [min, max].

    ``column_name, bin, bin_lo, bin_hi, count`` for bins ``0..bins-1`` of
    every column (empty bins included); the max lands in the last bin; a
    constant column is one bin; missing values (null, NaN) are not counted;
    a column with no values has no rows. All columns share one scan: values
    are stacked, ranges come from a one-row-per-column aggregate (broadcast:
    its size is the number of columns), and bins are counted by a hash
    aggregate with map-side partial counts.
    """
    if not columns:
        return empty_report(df, "column_name string, bin int, bin_lo double, bin_hi double, count bigint")
    stacked = _stack(df, columns)
    ranges = (stacked.groupBy("column_name")
              .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
              .withColumn("width", F.col("hi") - F.col("lo")))
    v, lo, width = F.col("v"), F.col("lo"), F.col("width")
    idx = (F.when(width == 0, F.lit(0))
           .otherwise(F.least(F.floor((v - lo) / width * bins), F.lit(bins - 1)))
           .cast("int"))
    counts = (stacked.join(F.broadcast(ranges), "column_name")
              .groupBy("column_name", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    b = F.col("bin")
    all_bins = (ranges.select("column_name", "lo", "width",
                              F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
                .filter((width > 0) | (b == 0)))
    return (all_bins.join(counts, ["column_name", "bin"], "left")
            .select("column_name", b,
                    (lo + width * b / bins).alias("bin_lo"),
                    (lo + width * (b + 1) / bins).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram of one numeric column (see :func:`histograms`)."""
    return histograms(df, [column], bins)
