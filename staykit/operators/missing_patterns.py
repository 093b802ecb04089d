"""How values are missing: patterns, pairs and what goes with it (A2, the to-do on missing values).

A row's pattern is the list of its missing columns. Patterns are counted by
one hash aggregate (partial counts per task); the pairs are summed from the
patterns, not from the rows. Null and NaN are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing
from ..session import checkpoint_root
from .multivariate import _unsigned
from .profile import _round
from .quantiles import _present, empty_report


def _marked(df: DataFrame, columns: list[str]) -> DataFrame:
    marks = [F.when(is_missing(c, df.schema[c].dataType), F.lit(c)) for c in columns]
    return df.select(F.filter(F.array(*marks), lambda m: m.isNotNull()).alias("missing")).groupBy("missing").agg(F.count(F.lit(1)).alias("n_rows"))


def missing_patterns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``pattern, n_missing, n_rows, percent``: how many rows lack just these columns, most rows first.

    ``pattern`` is the columns' names in table order, comma-joined; '' is a complete row.
    """
    columns = df.columns if columns is None else columns
    if not columns:
        return empty_report(df, "pattern string, n_missing int, n_rows bigint, percent double")
    counts = _marked(df, columns)
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.select(F.array_join("missing", ",").alias("pattern"), F.size("missing").alias("n_missing"), "n_rows",
                         (F.col("n_rows") / total * 100).alias("percent")).orderBy(F.col("n_rows").desc(), "pattern")


def co_missing(df: DataFrame, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """``column_a, column_b, n_both, n_only_a, n_only_b, n_neither, phi`` of each pair of columns that miss a value.

    ``phi`` is the correlation of the two columns' missingness, null where one
    is always missing. Columns without a missing value have no rows.
    """
    columns = df.columns if columns is None else columns
    if len(columns) < 2:
        return empty_report(df, "column_a string, column_b string, n_both bigint, n_only_a bigint, n_only_b bigint, n_neither bigint, phi double")
    checkpoint_root(df.sparkSession)
    counts = _marked(df, columns).checkpoint()                      # a row a pattern
    total = counts.agg(F.sum("n_rows")).scalar()
    order = F.array(*[F.lit(c) for c in columns])
    one = counts.select(F.explode("missing").alias("c"), "n_rows").groupBy("c").agg(F.sum("n_rows").alias("n"))
    a = one.select(F.col("c").alias("column_a"), F.col("n").alias("na"))
    b = one.select(F.col("c").alias("column_b"), F.col("n").alias("nb"))
    two = counts.select("missing", "n_rows", F.explode("missing").alias("column_a")).select(
        "column_a", "n_rows", F.explode("missing").alias("column_b")).groupBy("column_a", "column_b").agg(F.sum("n_rows").alias("n_both"))
    # every pair of the listed columns, both for pairs that are never missing together
    names = df.sparkSession.createDataFrame([(x, y) for i, x in enumerate(columns) for y in columns[i + 1:]], "column_a string, column_b string")
    pairs = names.join(F.broadcast(a), "column_a").join(F.broadcast(b), "column_b").join(F.broadcast(two), ["column_a", "column_b"], "left")
    both = F.coalesce("n_both", F.lit(0).cast("long"))
    pairs = pairs.select("column_a", "column_b", both.alias("n_both"), (F.col("na") - both).alias("n_only_a"), (F.col("nb") - both).alias("n_only_b"),
                         (total - F.col("na") - F.col("nb") + both).alias("n_neither"), "na", "nb", total.alias("n"))
    n, x, y = (F.col(c).cast("double") for c in ("n", "na", "nb"))
    phi = F.when((F.col("na") < F.col("n")) & (F.col("nb") < F.col("n")),
                 (n * F.col("n_both") - x * y) / (F.sqrt(x * (n - x)) * F.sqrt(y * (n - y))))
    out = pairs.withColumn("phi", _unsigned(phi, digits)).drop("na", "nb", "n")
    return out.orderBy(F.array_position(order, F.col("column_a")), F.array_position(order, F.col("column_b")))


def missing_effect(df: DataFrame, value: str, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """``column_name, n_missing, n_present, mean_missing, mean_present, difference, t``: does ``value`` differ where a column is missing?

    Counts and means are over the rows with a ``value``; ``t`` is Welch's
    statistic, null with fewer than two rows or no spread on a side. One pass
    over the rows; columns missing everywhere or nowhere have null differences.
    """
    columns = [c for c in (df.columns if columns is None else columns) if c != value]
    if not columns:
        return empty_report(df, "column_name string, n_missing bigint, n_present bigint, mean_missing double, mean_present double, "
                                "difference double, t double")
    v = _present(df, value)
    aggs, structs = [], []
    for i, c in enumerate(columns):
        gone = is_missing(c, df.schema[c].dataType)
        for side, x in (("m", F.when(gone, v)), ("p", F.when(~gone, v))):
            aggs += [F.count(x).alias(f"n{side}{i}"), F.avg(x).alias(f"a{side}{i}"), F.var_samp(x).alias(f"v{side}{i}")]
        nm, np_, am, ap, vm, vp = (F.col(f"{k}{s}{i}") for k in "nav" for s in "mp")
        error = vm / nm + vp / np_
        structs.append(F.struct(F.lit(c).alias("column_name"), nm.alias("n_missing"), np_.alias("n_present"), _round(am, digits).alias("mean_missing"),
                                _round(ap, digits).alias("mean_present"), _unsigned(am - ap, digits).alias("difference"),
                                _unsigned(F.when((nm > 1) & (np_ > 1) & (error > 0), (am - ap) / F.sqrt(error)), digits).alias("t")))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))
