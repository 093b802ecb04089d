"""How two loads of a table differ, column by column.

Numeric columns get the two-sample Kolmogorov-Smirnov statistic and a
population stability index over the first load's deciles; both are exact.
The statistic needs running counts of both loads in value order: distinct
values are counted by a hash aggregate, dealt over tasks by value range, and
each task adds to its own running counts those of the ranges before it, so no
task orders a whole column.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .profile import _numeric, _round
from .quantiles import _stack, empty_report, quantile_values

_SCHEMA = "column_name string, n_before bigint, n_after bigint, ks double, psi double"


def _running(counts: DataFrame) -> DataFrame:
    """``column_name, a, b``: values up to each distinct one, in both loads."""
    dealt = counts.repartitionByRange(F.col("column_name"), F.col("v")).withColumn("_part", F.spark_partition_id()).checkpoint()
    before = Window.partitionBy("column_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("column_name", "_part").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).select(
        F.col("column_name").alias("_c"), F.col("_part").alias("_p"), F.coalesce(F.sum("a").over(before.partitionBy("column_name")), F.lit(0)).alias("_a"),
        F.coalesce(F.sum("b").over(before.partitionBy("column_name")), F.lit(0)).alias("_b"))
    within = Window.partitionBy("column_name", "_part").orderBy("v")
    # a row for each column and task
    return dealt.join(F.broadcast(parts), (F.col("column_name") == F.col("_c")) & (F.col("_part") == F.col("_p"))).select(
        "column_name", (F.col("_a") + F.sum("a").over(within)).alias("a"), (F.col("_b") + F.sum("b").over(within)).alias("b"))


def ks_statistic(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, n_before, n_after, ks``: the greatest distance of the two loads' distribution functions; null if one has no value."""
    checkpoint_root(before.sparkSession)
    both = _stack(before, columns).withColumns({"a": F.lit(1), "b": F.lit(0)}).unionByName(
        _stack(after, columns).withColumns({"a": F.lit(0), "b": F.lit(1)}))
    counts = both.groupBy("column_name", F.when(F.col("v") == 0, 0.0).otherwise(F.col("v")).alias("v")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    run = _running(counts).checkpoint()
    totals = run.groupBy("column_name").agg(F.max("a").alias("n_before"), F.max("b").alias("n_after")).select(
        F.col("column_name").alias("_c"), "n_before", "n_after")
    away = F.abs(F.col("a") / F.nullif("n_before", F.lit(0)) - F.col("b") / F.nullif("n_after", F.lit(0)))
    return run.join(F.broadcast(totals), F.col("column_name") == F.col("_c")).groupBy("column_name", "n_before", "n_after").agg(
        F.max(away).alias("ks"))                            # totals: a row a column


def stability(before: DataFrame, after: DataFrame, columns: list[str], bins: int = 10) -> dict[str, float | None]:
    """Population stability index over the quantile bins of ``before``, by column.

    A bin that one load leaves empty counts as half a row there. None if a load has
    no value of the column.
    """
    cuts = {c: sorted(set(q.values())) for c, q in quantile_values(before, columns, [i / bins for i in range(1, bins)]).items()}
    if not cuts:
        return {}
    shares = []
    for df in (before, after):
        stacked = _stack(df, list(cuts))
        at = F.lit(0)
        for c, own in cuts.items():
            at = F.when(F.col("column_name") == c, sum((F.when(F.col("v") > x, 1).otherwise(0) for x in own), F.lit(0))).otherwise(at)
        counts: dict[str, dict[int, int]] = {}
        for r in stacked.groupBy("column_name", at.alias("bin")).count().collect():         # at most ``bins`` rows a column
            counts.setdefault(r["column_name"], {})[r["bin"]] = r["count"]
        shares.append(counts)
    out: dict[str, float | None] = {}
    for c, own in cuts.items():
        a, b = (s.get(c, {}) for s in shares)
        if not a or not b:
            out[c] = None
            continue
        na, nb = sum(a.values()), sum(b.values())
        out[c] = math.fsum((max(b.get(i, 0), 0.5) / nb - max(a.get(i, 0), 0.5) / na) * math.log((max(b.get(i, 0), 0.5) / nb) / (max(a.get(i, 0), 0.5) / na))
                           for i in range(len(own) + 1) if a.get(i) or b.get(i))
    return out


def drift_report(before: DataFrame, after: DataFrame, columns: list[str] | None = None, bins: int = 10, digits: int | None = None) -> DataFrame:
    """``column_name, n_before, n_after, ks, psi`` of each numeric column of both loads with a value in one of them. Runs its passes at once."""
    shared = [c for c in (before.columns if columns is None else columns)
              if c in before.columns and c in after.columns and _numeric(before, c) and _numeric(after, c)]
    if not shared:
        return empty_report(before, _SCHEMA)
    psi = stability(before, after, shared, bins)
    ks = ks_statistic(before, after, shared)
    found = before.sparkSession.createDataFrame([(c, psi.get(c)) for c in shared], "_p string, psi double")
    return ks.join(F.broadcast(found), F.col("column_name") == F.col("_p"), "left").select(
        "column_name", "n_before", "n_after", _round(F.col("ks"), digits).alias("ks"), (_round(F.col("psi"), digits) + F.lit(0.0)).alias("psi"))
