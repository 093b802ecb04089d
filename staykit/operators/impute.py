"""Imputation with a flag column per imputed field.

Every fill adds ``<column>_imputed`` (true where the value was missing), as
the reference's notes require. Fill values that depend on the data are
computed by uncorrelated scalar subqueries: Spark runs each as a small
aggregate job and plants the result in the projection as a literal, so
the imputed frame is never joined and nothing goes through the driver;
scalar aggregates over the same frame are merged into one job by the
optimizer.

Scale notes: ``mean`` and ``zero`` are constant-size. ``median`` is exact
(equal to ``percentile(x, 0.5)``) but computed by the bounded multi-pass
refinement of :mod:`.quantiles`, so no task holds the column's distinct
values; ``median_approx`` merges KLL sketches on two levels. ``mode`` counts
the values of all columns in one stacked hash aggregate (partial counts
combined map-side, so one hot value is cheap); the best row of each column is
an aggregate of the counts, and every column's subquery reads that one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING_CATEGORY, is_floating, is_missing
from .quantiles import approx_quantiles, exact_quantiles, group_quantiles

FLAG_SUFFIX, LEVEL_SUFFIX = "_imputed", "_imputed_from"
#: What :func:`impute_grouped` calls the level without a key.
ALL = "all"


def _missing(df: DataFrame, c: str) -> Column:
    return is_missing(c, df.schema[c].dataType)


def _clean(df: DataFrame, c: str) -> Column:
    """The value with NaN turned into null, so ``coalesce`` sees it as missing."""
    col = F.col(c)
    if is_floating(df.schema[c].dataType):
        return F.when(F.isnan(col), F.lit(None).cast(df.schema[c].dataType)).otherwise(col)
    return col


def _numeric_value(df: DataFrame, c: str) -> Column:
    """Value with NaN read as null; aggregates skip both. No row filter, so
    the scalar aggregates of several columns share one plan and Spark merges
    them into a single job."""
    return _clean(df, c)


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: for each column its most frequent present value, lowest on ties.

    One scan: each column's values sit in a slot of their own type, so they
    keep their order and never collide.
    """
    slots = F.array(*[
        F.struct(F.lit(i).alias("at"), *[
            (_clean(df, c) if j == i else F.lit(None).cast(df.schema[d].dataType)).alias(f"v{j}")
            for j, d in enumerate(columns)])
        for i, c in enumerate(columns)])
    counts = df.select(F.inline(slots)).groupBy("at", *[f"v{j}" for j in range(len(columns))]).count()
    # ties: the lowest value among those with the greatest count
    top = counts.groupBy("at").agg(F.max(F.when(F.coalesce(*[F.col(f"v{j}").cast("string") for j in range(len(columns))]).isNotNull(),
                                                F.col("count"))).alias("most")).withColumnRenamed("at", "_at")
    ties = counts.join(F.broadcast(top), (F.col("at") == F.col("_at")) & (F.col("count") == F.col("most")))
    return ties.agg(*[F.min(F.col(f"v{i}")).alias(c) for i, c in enumerate(columns)])


def _fills(df: DataFrame, columns: list[str], method: str) -> dict[str, Column]:
    """Fill value of each column: fields of one scalar subquery, so one job finds them all."""
    if method == "mean":
        row = df.agg(*[F.avg(_numeric_value(df, c)).alias(c) for c in columns])
    elif method in ("median", "median_approx"):
        q = exact_quantiles(df, columns, [0.5]) if method == "median" else approx_quantiles(df, columns, [0.5], ["value"])
        row = q.agg(*[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns])
    elif method == "mode":
        row = modes(df, columns)
    else:
        raise ValueError(f"unknown fill method {method!r}")
    found = row.select(F.struct(*columns)).scalar()
    return {c: found.getField(c) for c in columns}


def impute(df: DataFrame, columns: list[str], method: str = "mean",
           value=None, flag: bool = True) -> DataFrame:
    """Fill missing values of ``columns`` and add ``<col>_imputed`` flags.

    ``method``: ``mean``, ``median``, ``median_approx``, ``zero`` (numeric),
    ``mode`` (any type), ``category`` (text: ``value`` or ``__missing__``),
    ``constant`` (``value``). NaN is treated as missing throughout.
    """
    new: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    fills = {} if method in ("zero", "constant", "category") else _fills(df, columns, method)
    for c in columns:
        dtype = df.schema[c].dataType
        if method == "zero":
            fill = F.lit(0).cast(dtype)
        elif method == "constant":
            fill = F.lit(value).cast(dtype)
        elif method == "category":
            fill = F.lit(MISSING_CATEGORY if value is None else value).cast(dtype)
        else:
            fill = fills[c]
        new[c] = F.coalesce(_clean(df, c), fill)
        if flag:
            flags[c + FLAG_SUFFIX] = _missing(df, c)
    return df.withColumns({**new, **flags})


def fill_constant(df: DataFrame, values: dict[str, object], flag: bool = True) -> DataFrame:
    """``fillna`` with per-column constants (NaN filled too), plus flags."""
    new = {c: F.coalesce(_clean(df, c), F.lit(v).cast(df.schema[c].dataType))
           for c, v in values.items()}
    flags = {c + FLAG_SUFFIX: _missing(df, c) for c in values} if flag else {}
    return df.withColumns({**new, **flags})


def _grouped(df: DataFrame, by: list[str], columns: list[str], method: str) -> DataFrame:
    """``g`` (the keys as a struct), then for each column ``v<i>`` (fill value) and ``n<i>`` (present values), one row a group."""
    g = F.struct(*by).alias("g")
    if method == "median":
        return group_quantiles(df, by, columns, 0.5).groupBy("g").agg(*[a for i, c in enumerate(columns) for a in (
            F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(f"v{i}"), F.max(F.when(F.col("column_name") == c, F.col("n"))).alias(f"n{i}"))])
    if method == "mean":
        return df.select(g, *[_clean(df, c).alias(f"c{i}") for i, c in enumerate(columns)]).groupBy("g").agg(*[
            a for i in range(len(columns)) for a in (F.avg(f"c{i}").alias(f"v{i}"), F.count(f"c{i}").alias(f"n{i}"))])
    if method != "mode":
        raise ValueError(f"unknown grouped fill method {method!r}")
    slots = F.array(*[F.struct(F.lit(i).alias("at"), *[
        (_clean(df, c) if j == i else F.lit(None).cast(df.schema[d].dataType)).alias(f"c{j}") for j, d in enumerate(columns)]) for i, c in enumerate(columns)])
    names = [f"c{j}" for j in range(len(columns))]
    counts = df.select(g, F.inline(slots)).where(F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()).groupBy("g", "at", *names).agg(
        F.count(F.lit(1)).alias("n"))
    # the most frequent value, the lowest on ties
    return counts.groupBy("g").agg(*[a for i, c in enumerate(names) for a in (
        F.min(F.when(F.col("at") == i, F.struct(-F.col("n"), F.col(c).alias("v")))).getField("v").alias(f"v{i}"),
        F.sum(F.when(F.col("at") == i, F.col("n"))).alias(f"n{i}"))])


def impute_grouped(df: DataFrame, columns: list[str], levels: list[list[str]], method: str = "median", support: int = 1) -> DataFrame:
    """Fill missing values from a row's group, backing off to wider groups.

    ``levels`` are lists of key columns, the narrowest first; ``[]`` is the
    whole table. A value comes from the first level whose group has at least
    ``support`` present values; null keys are a group of their own. Adds
    ``<col>_imputed`` (the value was missing) and ``<col>_imputed_from``: the
    level's key names joined by ``+``, ``all`` for the whole table, null where
    nothing was missing or no level had a value. ``method``: ``median``
    (exact, numeric), ``mean`` (numeric), ``mode`` (any type, lowest on ties).

    Scale: each level is one aggregate (``mean``, ``mode``) or the bounded
    refinement of :func:`.quantiles.group_quantiles`; a level's table has a
    row a group and is joined on the key, with no side forced to be broadcast
    (a hot group is split by AQE's skew join); the whole table's values are
    one scalar subquery.
    """
    out = df
    found: list[tuple[str, list[Column], list[Column]]] = []
    for k, by in enumerate(levels):
        if by:
            table = _grouped(df, by, columns, method).select(F.col("g").alias(f"_g{k}"), *[
                F.col(f"{x}{i}").alias(f"_{x}{k}_{i}") for i in range(len(columns)) for x in "vn"])
            out = out.join(table, F.struct(*[F.col(c) for c in by]) == F.col(f"_g{k}"), "left")
            values, counts = ([F.col(f"_{x}{k}_{i}") for i in range(len(columns))] for x in "vn")
        else:
            one = _grouped(df.withColumn("_all", F.lit(1)), ["_all"], columns, method)
            names = [f"{x}{i}" for i in range(len(columns)) for x in "vn"]
            row = one.agg(*[F.first(n).alias(n) for n in names]).select(F.struct(*names)).scalar()
            values, counts = ([row.getField(f"{x}{i}") for i in range(len(columns))] for x in "vn")
        found.append(("+".join(by) or ALL, values, counts))
    new: dict[str, Column] = {}
    for i, c in enumerate(columns):
        gone, value, level = _missing(df, c), F.lit(None), F.lit(None)
        for name, values, counts in reversed(found):
            enough = (counts[i] >= support) & values[i].isNotNull()
            value, level = F.when(enough, values[i]).otherwise(value), F.when(enough, F.lit(name)).otherwise(level)
        new[c] = F.when(gone, value.cast(df.schema[c].dataType)).otherwise(F.col(c))
        new[c + FLAG_SUFFIX] = gone
        new[c + LEVEL_SUFFIX] = F.when(gone, level)
    kept = [c for c in df.columns if c not in new]
    order = [F.col(c) if c in kept else new[c].alias(c) for c in df.columns]
    return out.select(*order, *[v.alias(c) for c, v in new.items() if c not in df.columns])
