"""Exact quantiles by refinement, and mergeable sketches, for many columns at once.

Spark's exact ``percentile`` (and ``median``) merges, in one task, a buffer
holding every distinct value of the column. This module gets the same
numbers (linear interpolation between the values at ranks ``floor`` and
``ceil`` of ``p * (n - 1)``) from a few distributed passes:

1. per column: row count, least and greatest value, one plain aggregate;
2. values between an interval's ends are counted in ``BINS`` equal-width bins,
   a hash aggregate of at most ``BINS`` rows an interval and task; the bins
   holding the target ranks become the next intervals, with the least and
   greatest value seen in them as ends (so empty stretches cost no
   resolution). An interval whose ends are equal is an answer. This is
   repeated, for the columns that still need it, until every interval is an
   answer or holds ``MOST`` rows at most;
3. what is left, at most ``MOST`` rows an interval, is ranked exactly.

How the values are spread decides the number of passes, never how much one
task holds: outliers of many magnitudes or a value of most rows take a pass
more. Only interval ends come back to the driver, two a target rank.
:func:`grouped_quantiles` does the same for the groups of a key, with the
intervals in a DataFrame, since there may be any number of them.

:func:`approx_quantiles` merges KLL sketches on two levels, so no task reads
more than about ``tasks / FAN_IN`` of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_floating
from ..session import checkpoint_root

#: Bins a round, and the rows of an interval that are few enough to be ranked.
BINS, MOST = 4096, 200_000
#: Bins a round of a group (there may be very many groups).
GROUP_BINS = 256
#: KLL sketch size (its rank error is well under 1 / 1000) and level-one groups.
SKETCH_K, FAN_IN = 4096, 512
#: Rank error the approximate reports promise.
RANK_ERROR = 0.005


def empty_report(df: DataFrame, ddl: str) -> DataFrame:
    """A typed, empty report (no eligible columns)."""
    return df.sparkSession.createDataFrame([], ddl)


def _present(df: DataFrame, c: str) -> Column:
    """The value as a double, null if it is missing (null, NaN)."""
    col = F.col(c)
    if is_floating(df.schema[c].dataType):
        col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col.cast("double")


def _stack(df: DataFrame, columns: list[str], *keys: Column) -> DataFrame:
    """``column_name, v`` (after the keys) for every present (not null, not NaN) value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), _present(df, c).alias("v")) for c in columns])
    return df.select(*keys, F.inline(pairs)).filter(F.col("v").isNotNull())


def _bin(bins: int) -> Column:
    """The bin of ``v`` between ``lo`` and ``hi``."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    inf = F.lit(float("inf"))
    # halves, so that the width of the whole double range is finite; an
    # interval with an infinite end only sets its infinities apart
    place = F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * bins)
    return (F.when(v == -inf, -1).when(v == inf, bins).when((lo == hi) | (lo == -inf) | (hi == inf), 0)
            .otherwise(F.least(place, F.lit(bins - 1))).cast("int"))


def _ranks(n: int, p: float) -> tuple[int, int]:
    pos = p * (n - 1)
    return math.floor(pos), math.ceil(pos)


_INTERVAL = "_c string, before long, lo double, hi double"


def _narrowed(df: DataFrame, intervals: list[tuple], targets: list[tuple], by) -> list:
    """The parts of the intervals, counted by ``by``, that hold a target rank: ``column_name, start, lo, hi, cnt``."""
    spark = df.sparkSession
    held = spark.createDataFrame([i[:4] for i in intervals], _INTERVAL)                # two a target rank at most
    ranks = spark.createDataFrame(targets, "_t string, rank long")
    stacked = _stack(df, sorted({i[0] for i in intervals}))
    inside = stacked.join(F.broadcast(held), (F.col("column_name") == F.col("_c")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    counted = inside.groupBy("column_name", "before", by.alias("_at")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    w = Window.partitionBy("column_name", "before").orderBy("_at")
    spans = counted.withColumn("start", F.col("before") + F.sum("cnt").over(w) - F.col("cnt"))
    hit = spans.join(F.broadcast(ranks), (F.col("column_name") == F.col("_t")) & (F.col("rank") >= F.col("start"))
                     & (F.col("rank") < F.col("start") + F.col("cnt")))
    return [tuple(r) for r in hit.select("column_name", "start", "lo", "hi", "cnt").distinct().collect()]


def quantile_values(df: DataFrame, columns: list[str], probs: list[float], bins: int = BINS,
                    rounds: int | None = None, most: int = MOST) -> dict[str, dict[float, float]]:
    """Exact quantiles by column and probability; columns without a present value are left out.

    Runs its passes at once. ``rounds`` bounds the refining rounds (default:
    as many as it takes), ``most`` is what may be ranked without refining.
    """
    if not columns:
        return {}
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(_present(df, c)).alias(f"n{i}"), F.min(_present(df, c)).alias(f"lo{i}"), F.max(_present(df, c)).alias(f"hi{i}"))]).first()
    n = {c: row[f"n{i}"] for i, c in enumerate(columns) if row[f"n{i}"]}
    ranks = {c: sorted({r for p in probs for r in _ranks(n[c], p)}) for c in n}
    intervals = [(c, 0, row[f"lo{i}"], row[f"hi{i}"], n[c]) for i, c in enumerate(columns) if c in n]
    found: dict[tuple[str, int], float] = {}
    done = 0
    while True:
        rest = []
        for c, before, lo, hi, cnt in intervals:
            if lo == hi:
                found.update({(c, r): lo for r in ranks[c] if before <= r < before + cnt})
            else:
                rest.append((c, before, lo, hi, cnt))
        if not rest:
            break
        open_ = [(c, r) for c in ranks for r in ranks[c] if (c, r) not in found]
        # a count by value where little is left, else by bin
        few = done == rounds or max(i[4] for i in rest) <= most
        intervals = _narrowed(df, rest, open_, F.col("v") if few else _bin(bins))
        done += 1

    def value(c: str, p: float) -> float:
        pos, (a, b) = p * (n[c] - 1), _ranks(n[c], p)
        return found[c, a] if found[c, a] == found[c, b] else (b - pos) * found[c, a] + (pos - a) * found[c, b]

    return {c: {p: value(c, p) for p in probs} for c in n}


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], bins: int = BINS,
                    rounds: int | None = None, most: int = MOST) -> DataFrame:
    """``column_name, p, value``: exact quantiles, equal to ``percentile`` (see :func:`quantile_values`).

    Columns with no present value give no rows. Infinities count as values.
    """
    found = quantile_values(df, columns, probs, bins, rounds, most)
    return df.sparkSession.createDataFrame(
        [(c, float(p), v) for c, own in found.items() for p, v in own.items()], "column_name string, p double, value double")


def grouped_quantiles(df: DataFrame, by: list[str], columns: list[str], p: float = 0.5, bins: int = GROUP_BINS,
                      most: int = MOST) -> DataFrame:
    """``<by...>, column_name, n, value``: the exact quantile of each group, null keys a group of their own.

    Groups without a present value have no row. Intervals are joined on the
    group, and what is counted leaves each task as ``bins`` rows an interval
    at most, so a group of most rows is not one task.
    """
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    if not columns:
        return empty_report(df, f"{schema}, column_name string, n bigint, value double")
    return group_quantiles(df, by, columns, p, bins, most).select("g.*", "column_name", "n", "value")


def group_quantiles(df: DataFrame, by: list[str], columns: list[str], p: float, bins: int = GROUP_BINS, most: int = MOST) -> DataFrame:
    """:func:`grouped_quantiles` with the keys in one struct ``g``."""
    checkpoint_root(df.sparkSession)
    values = _stack(df, columns, F.struct(*by).alias("g"))
    stats = values.groupBy("g", "column_name").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).checkpoint()
    pos = F.lit(p) * (F.col("n") - 1)
    targets = stats.select("g", "column_name", "n", F.inline(F.array(
        *[F.struct(F.lit(side).alias("side"), r.cast("long").alias("rank")) for side, r in (("a", F.floor(pos)), ("b", F.ceil(pos)))])),
        F.lit(0).cast("long").alias("before"), "lo", "hi", F.col("n").alias("cnt"))
    while True:
        left = targets.where("lo < hi").agg(F.max("cnt")).first()[0]
        if left is None:
            break
        held = targets.where("lo < hi").select(F.col("g").alias("_g"), F.col("column_name").alias("_c"), "before", "lo", "hi").distinct()
        inside = values.join(held, (F.col("g") == F.col("_g")) & (F.col("column_name") == F.col("_c")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        at = F.col("v") if left <= most else _bin(bins)
        counted = inside.groupBy("_g", "_c", F.col("before").alias("_before"), at.alias("_at")).agg(
            F.count(F.lit(1)).alias("_cnt"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
        w = Window.partitionBy("_g", "_c", "_before").orderBy("_at")
        spans = counted.withColumn("_start", F.col("_before") + F.sum("_cnt").over(w) - F.col("_cnt"))
        hit = targets.where("lo < hi").join(spans, (F.col("g") == F.col("_g")) & (F.col("column_name") == F.col("_c")) & (F.col("before") == F.col("_before"))
                                            & (F.col("rank") >= F.col("_start")) & (F.col("rank") < F.col("_start") + F.col("_cnt")))
        targets = targets.where("lo = hi").unionByName(hit.select(
            "g", "column_name", "n", "side", "rank", F.col("_start").alias("before"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
            F.col("_cnt").alias("cnt"))).checkpoint()
    ends = targets.groupBy("g", "column_name", "n").agg(
        F.max(F.when(F.col("side") == "a", F.col("lo"))).alias("a"), F.max(F.when(F.col("side") == "b", F.col("lo"))).alias("b"))
    lower, higher = F.floor(pos), F.ceil(pos)
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((higher - pos) * F.col("a") + (pos - lower) * F.col("b"))
    return ends.select("g", "column_name", "n", value.alias("value"))


def approx_quantiles(df: DataFrame, columns: list[str], probs: list[float], names: list[str],
                     k: int = SKETCH_K) -> DataFrame:
    """``column_name, <names...>``: quantiles of KLL sketches merged on two levels."""
    part = F.pmod(F.spark_partition_id(), F.lit(FAN_IN))
    first = _stack(df, columns).groupBy("column_name", part.alias("part")).agg(F.kll_sketch_agg_double("v", k).alias("s"))
    merged = first.groupBy("column_name").agg(F.kll_merge_agg_double("s", k).alias("s"))
    return merged.select("column_name", *[
        F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias(n) for p, n in zip(probs, names)])


def exact_quantile_columns(df: DataFrame, columns: list[str], probs: list[float],
                           names: list[str], **kwargs) -> DataFrame:
    """Quantiles pivoted to one row per column: ``column_name, <names...>``."""
    q = exact_quantiles(df, columns, probs, **kwargs)
    return q.groupBy("column_name").agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in zip(probs, names)
    ])


def exact_median(df: DataFrame, column: str, **kwargs):
    """The exact median of one column as a scalar-subquery Column."""
    return exact_quantiles(df, [column], [0.5], **kwargs).select("value").scalar()
