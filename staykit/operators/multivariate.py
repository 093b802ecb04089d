"""Several columns at once: association in the profile (A9), unusual rows.

Means, variances and co-moments of all pairs of numeric columns come from one
aggregate of Spark's mergeable moments; its one row is all the driver sees.
Contingency tables are counted for all pairs of text columns in one pass
over the rows, after rare values have become one, so their cells are bounded.
"""

from __future__ import annotations

from itertools import combinations
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import _numeric, _round, _text, top_values
from .quantiles import _present, empty_report

#: Values of a text column that keep a level of their own; the others share one.
LEVELS = 50
OTHER = "__other__"
#: Share of its variance a column must have beside the columns before it.
LEAST_OWN = 1e-9


def _unsigned(c: Column, digits: int | None) -> Column:
    """Rounded, without a negative zero."""
    return _round(c, digits) + F.lit(0.0)


def numeric_association(df: DataFrame, columns: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """``column_a, column_b, n, covariance, correlation`` of all pairs of numeric columns, over the rows where both are present.

    Correlation is null where a column is constant; covariance with fewer than two rows.
    """
    columns = [c for c in (df.columns if columns is None else columns) if _numeric(df, c)]
    schema = "column_a string, column_b string, n bigint, covariance double, correlation double"
    pairs = list(combinations(columns, 2))
    if not pairs:
        return empty_report(df, schema)
    aggs, structs = [], []
    for i, (a, b) in enumerate(pairs):
        both = _present(df, a).isNotNull() & _present(df, b).isNotNull()
        x, y = F.when(both, _present(df, a)), F.when(both, _present(df, b))
        aggs += [F.count(x).alias(f"n{i}"), F.covar_samp(x, y).alias(f"c{i}"), F.stddev_samp(x).alias(f"x{i}"), F.stddev_samp(y).alias(f"y{i}")]
        r = F.when((F.col(f"x{i}") > 0) & (F.col(f"y{i}") > 0), F.col(f"c{i}") / (F.col(f"x{i}") * F.col(f"y{i}")))
        structs.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"n{i}").alias("n"),
                                _unsigned(F.col(f"c{i}"), digits).alias("covariance"), _unsigned(r, digits).alias("correlation")))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))


def text_association(df: DataFrame, columns: list[str] | None = None, levels: int = LEVELS, digits: int | None = None) -> DataFrame:
    """``column_a, column_b, n, levels_a, levels_b, chi2, cramers_v`` of all pairs of text columns, over the rows where both are present.

    A column's ``levels`` most frequent values (lowest first on ties) are
    levels of their own, all others together are one more, so a pair has at
    most ``(levels + 1) ** 2`` cells. Cramér's V is null where a side has one level.
    """
    columns = [c for c in (df.columns if columns is None else columns) if _text(df, c)]
    pairs = list(combinations(columns, 2))
    if not pairs:
        return empty_report(df, "column_a string, column_b string, n bigint, levels_a bigint, levels_b bigint, chi2 double, cramers_v double")
    kept: dict[str, list[str]] = {c: [] for c in columns}
    for r in top_values(df, columns, levels, skip_missing=True).collect():          # at most ``levels`` rows a column
        kept[r["column_name"]].append(r["value"])
    level = {c: F.when(F.col(c).isNull(), None).when(F.col(c).isin(kept[c]), F.col(c)).otherwise(F.lit(OTHER)) if kept[c]
             else F.lit(None).cast("string") for c in columns}
    slim = df.select(*[v.alias(f"v{i}") for i, v in enumerate(level.values())])
    at = {c: f"v{i}" for i, c in enumerate(columns)}
    cells = slim.select(F.inline(F.array(*[F.struct(F.lit(i).alias("pair"), F.col(at[a]).alias("a"), F.col(at[b]).alias("b"))
                                           for i, (a, b) in enumerate(pairs)]))).where("a is not null and b is not null")
    cells = cells.groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy("pair", "a").agg(F.sum("o").alias("ra")).withColumnsRenamed({"pair": "_p", "a": "_a"})
    cols = cells.groupBy("pair", "b").agg(F.sum("o").alias("cb")).withColumnsRenamed({"pair": "_q", "b": "_b"})
    # sum of o^2 / (row total * column total): every table is a bounded number of cells
    full = cells.join(rows, (F.col("pair") == F.col("_p")) & (F.col("a") == F.col("_a"))).join(
        cols, (F.col("pair") == F.col("_q")) & (F.col("b") == F.col("_b")))
    part = F.col("o").cast("double") * F.col("o") / (F.col("ra").cast("double") * F.col("cb"))
    sums = full.groupBy("pair").agg(F.sum("o").alias("n"), F.count_distinct("a").alias("levels_a"), F.count_distinct("b").alias("levels_b"), F.sum(part).alias("s"))
    chi2 = F.greatest(F.col("n") * (F.col("s") - 1), F.lit(0.0))
    least = F.least("levels_a", "levels_b") - 1
    v = F.when(least > 0, F.sqrt(chi2 / (F.col("n") * least)))
    names = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b")) for a, b in pairs])
    return sums.select(F.element_at(names, F.col("pair") + 1).alias("_n"), "n", "levels_a", "levels_b", _round(chi2, digits).alias("chi2"),
                       _round(v, digits).alias("cramers_v")).select("_n.*", "n", "levels_a", "levels_b", "chi2", "cramers_v")


def moments(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, covariance matrix) over the rows where all ``columns`` are present: one pass, one row to the driver."""
    v = [_present(df, c) for c in columns]
    full = v[0].isNotNull()
    for x in v[1:]:
        full = full & x.isNotNull()
    x = [F.when(full, a) for a in v]
    k = len(columns)
    row = df.agg(F.count(x[0]).alias("n"), *[F.avg(a).alias(f"m{i}") for i, a in enumerate(x)], *[
        F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    if row["n"] < 2:
        return row["n"], np.zeros(k), np.zeros((k, k))
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    return row["n"], np.array([row[f"m{i}"] for i in range(k)]), cov


def independent(cov: np.ndarray, least: float = LEAST_OWN) -> list[int]:
    """The columns that aren't constant and not a linear function of those before them."""
    kept: list[int] = []
    for j in range(len(cov)):
        own = cov[j, j]
        if kept:
            a = cov[np.ix_(kept, kept)]
            own = own - cov[j, kept] @ np.linalg.solve(a, cov[kept, j])
        if own > least * cov[j, j] and cov[j, j] > 0:
            kept.append(j)
    return kept


def usual_limit(k: int, share: float) -> float:
    """About the distance squared that a share of normal rows of k columns stays below (Wilson and Hilferty)."""
    z = NormalDist().inv_cdf(share)
    return k * (1 - 2 / (9 * k) + z * (2 / (9 * k)) ** 0.5) ** 3


def unusual_rows(df: DataFrame, columns: list[str], share: float = 0.999, digits: int | None = None) -> DataFrame:
    """The rows with ``distance2`` and ``is_unusual``.

    ``distance2`` is the squared Mahalanobis distance from the mean over
    ``columns``: how far a row lies from all others if the columns' spread
    and correlation are taken into account. A row with a missing value has
    null in both. Constant columns, and columns that are a linear function of
    those before them, add nothing and are left out; if none is left, or
    fewer than two rows are complete, both are null everywhere. One pass
    finds the matrix; it is inverted once, and rows are scored natively.
    """
    n, mean, cov = moments(df, columns)
    kept = independent(cov) if n >= 2 else []
    if not kept:
        return df.withColumns({"distance2": F.lit(None).cast("double"), "is_unusual": F.lit(None).cast("boolean")})
    inverse = np.linalg.inv(cov[np.ix_(kept, kept)])
    away = [_present(df, columns[j]) - F.lit(float(mean[j])) for j in kept]
    total: Column = F.lit(0.0)
    for a in range(len(kept)):
        for b in range(a, len(kept)):
            total = total + F.lit(float(inverse[a, b] * (1 if a == b else 2))) * away[a] * away[b]
    for c in columns:                                                   # all columns decide whether a row is complete
        total = F.when(_present(df, c).isNotNull(), total)
    return df.withColumn("distance2", _round(total, digits)).withColumn("is_unusual", F.col("distance2") > usual_limit(len(kept), share))
