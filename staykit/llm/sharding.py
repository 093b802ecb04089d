"""Shards of near-equal bytes: best-fit-decreasing bin packing of whole groups.

Groups (rows with equal text) are indivisible. Sorted by size, each enters
the open shard with the tightest remaining capacity that still holds it,
found through a balanced tree; no fit opens a shard. The capacity is the
smallest for which this fills no more than the given number of shards, so
the shards come out near equal. A group larger than an equal share has a
shard to itself, as it can't be split, and the rest share the others.

Groups of one size are interchangeable, so packing runs over (size, count):
at most sqrt(2 * total bytes) entries, 14 million at 100 TB, whatever the
number of rows. Its result, runs of group ranks a size, is joined back.
Ranks and slots are counted in salted parts with offsets, so neither a common
size nor a shard is one task.

Edge cases: null text is empty and one group with empty texts; null doc_id
and repeated rows are rows like any other; with fewer groups than shards some
shards stay empty; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

HEADER = 16


class CapacityTree:
    """Balanced search tree (treap) of (remaining, shard) pairs."""

    __slots__ = ("root", "dice")

    def __init__(self):
        self.root, self.dice = None, random.Random(7)

    def insert(self, key: tuple[int, int]) -> None:
        less, more = self._split(self.root, key)
        self.root = self._join(self._join(less, [key, self.dice.random(), None, None]), more)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least remaining >= size."""
        node, found = self.root, None
        while node:
            if node[0][0] >= size:
                node, found = node[2], node
            else:
                node = node[3]
        if not found:
            return None
        less, rest = self._split(self.root, found[0])
        _, more = self._split(rest, (found[0][0], found[0][1] + 1))
        self.root = self._join(less, more)
        return found[0]

    def _split(self, node, key):
        """(nodes < key, nodes >= key)"""
        if not node:
            return None, None
        if node[0] < key:
            less, more = self._split(node[3], key)
            return [node[0], node[1], node[2], less], more
        less, more = self._split(node[2], key)
        return less, [node[0], node[1], more, node[3]]

    def _join(self, less, more):
        if not less or not more:
            return less or more
        if less[1] > more[1]:
            return [less[0], less[1], less[2], self._join(less[3], more)]
        return [more[0], more[1], self._join(less, more[2]), more[3]]


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, shards: int) -> list[tuple[int, int, int]] | None:
    """Runs (size, groups, shard) for (size, count) sorted by falling size; None if they don't fit."""
    tree, opened, out = CapacityTree(), 0, []
    for size, count in sizes:
        while count:
            found = tree.tightest(size)
            if found is None:
                if opened == shards or size > capacity:
                    return None
                found = (capacity, opened)
                opened += 1
            n = min(count, found[0] // size)
            out.append((size, n, found[1]))
            tree.insert((found[0] - n * size, found[1]))
            count -= n
    return out


def pack(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Runs (size, groups, shard) at the smallest capacity that suffices."""
    sizes = sorted(sizes, reverse=True)
    total, alone, out = sum(s * n for s, n in sizes), 0, []
    while sizes and shards - alone > 1 and sizes[0][0] * (shards - alone) > total:
        size, count = sizes[0]
        out.append((size, 1, alone))
        total -= size
        alone += 1
        sizes = ([(size, count - 1)] if count > 1 else []) + sizes[1:]
    left = shards - alone
    if not sizes:
        return out
    low = max(sizes[0][0], -(-total // left)) - 1                # too small, or just enough + 1
    high = low + 1 + sizes[0][0]
    best = best_fit_decreasing(sizes, high, left)
    while best is None:
        low, high = high, high + sizes[0][0]
        best = best_fit_decreasing(sizes, high, left)
    while high - low > 1 + low // 1_000_000:
        middle = (low + high) // 2
        got = best_fit_decreasing(sizes, middle, left)
        if got is None:
            low = middle
        else:
            high, best = middle, got
    return out + [(s, n, b + alone) for s, n, b in best]


def numbered(df: DataFrame, key: str, salt, order: list, name: str) -> DataFrame:
    """Gapless numbers from 0 within each key, counted in salted parts."""
    df = df.withColumn("_part", salt)
    counts = df.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part")) - F.col("_n")
    offsets = counts.select(F.col(key).alias("_key"), F.col("_part").alias("_of"), before.alias("_before"))
    local = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    return df.withColumn("_local", local).join(
        offsets, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of"))
    ).withColumn(name, (F.col("_before") + F.col("_local")).cast("long")).drop(
        "_part", "_local", "_key", "_of", "_before")


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    checkpoint_root(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + HEADER).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("digest")).checkpoint()
    groups = rows.groupBy(F.col("digest").alias("group")).agg(F.sum("size").alias("group_size"))
    sizes = [(r.group_size, r["n"]) for r in groups.groupBy("group_size").agg(F.count("*").alias("n")).toLocalIterator()]
    taken, runs = {}, []
    for size, n, where in pack(sizes, shards):
        start = taken.get(size, 0)
        runs.append((size, start, start + n, where))
        taken[size] = start + n
    plan = docs.sparkSession.createDataFrame(runs, "of_size long, start long, end long, shard int")
    ranked = numbered(groups, "group_size", F.pmod(F.xxhash64("group"), F.lit(64)), ["group"], "rank")
    placed = ranked.join(plan, (F.col("group_size") == F.col("of_size")) & (F.col("rank") >= F.col("start"))
                         & (F.col("rank") < F.col("end"))).select("group", "shard")
    parts = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    where = rows.join(placed, F.col("digest") == F.col("group"))
    salt = F.pmod(F.xxhash64("digest", "doc_id"), F.lit(parts))
    return numbered(where, "shard", salt, ["digest", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
