"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are short, documents long, so the question is containment: how much of
an item's ``shingle``-word shingle set a document holds. Items are
partitioned by set size into ranges [2^c, 2^(c+1)). A range whose largest
size is u gets bottom-k MinHash signatures of

    k = u - ceil(threshold * u) + 1

hashes: a document holding the threshold's share of an item misses fewer
than k of its shingles, so it holds at least one of its k smallest hashes.
The search therefore finds every pair, with no bands to tune and no document
signature to grow faint in long texts: a document probes the ranges' tables
with all of its shingle hashes, in numpy. Candidates are verified by exact
containment on the shingles' words.

The benchmark is a stated query set: it is read in blocks of ``block_items``,
each small enough to broadcast, and every block meets all documents. Nothing
is shuffled, no group is gathered, and repeated documents are searched alike.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words than
``shingle`` make one shingle of the whole text, for items and documents both.

Edge cases: null or blank items and documents have no shingles and match
nothing; repeated items and documents give a row for each pair of rows; null
ids are returned as they are; an empty table on either side gives no pairs;
other columns are ignored by :func:`pairs` and kept by :func:`clean`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import Words, slices

_GATE_BITS = 20
_PAIRS = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"


def _needed(threshold: float, size: int) -> int:
    return math.ceil(threshold * size - 1e-9)


def _shingle_set(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@dataclass
class Index:
    """One block of items: signatures by size range, and the exact sets."""

    ids: list
    sets: list[set[bytes]]
    hashes: np.ndarray                     # distinct signature hashes, sorted
    first: np.ndarray                      # items of each hash: members[first[i]:first[i + 1]]
    members: np.ndarray
    gate: np.ndarray                       # which leading bits any hash has
    shingle: int
    threshold: float

    @classmethod
    def build(cls, items: list[tuple], shingle: int, threshold: float) -> Index:
        w = Words(pa.array([t for _, t in items], pa.string()))
        h, doc, _ = w.shingles(shingle)
        pairs = []
        for i in range(len(items)):
            own = np.unique(h[doc == i]) if len(items) < 64 else np.unique(h[np.searchsorted(doc, i):np.searchsorted(doc, i + 1)])
            if len(own):
                upper = (1 << int(len(own)).bit_length()) - 1             # largest size of the item's range
                k = upper - _needed(threshold, upper) + 1
                pairs.append((own[:k], np.full(min(k, len(own)), i)))
        value = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.uint64)
        item = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
        order = np.argsort(value, kind="stable")
        hashes, first = np.unique(value[order], return_index=True)
        gate = np.zeros(1 << _GATE_BITS, bool)
        gate[hashes >> np.uint64(64 - _GATE_BITS)] = True
        return cls([i for i, _ in items], [_shingle_set(w.words_of(i), shingle) for i in range(len(items))], hashes,
                   np.append(first, len(value)), item[order], gate, shingle, threshold)

    def matches(self, column: pa.Array) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of every contained item."""
        w = Words(column)
        h, doc, _ = w.shingles(self.shingle)
        may = self.gate[h >> np.uint64(64 - _GATE_BITS)]
        h, doc = h[may], doc[may]
        at = np.searchsorted(self.hashes, h)
        at = np.minimum(at, max(0, len(self.hashes) - 1))
        hit = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        at, doc = at[hit], doc[hit]
        n = self.first[at + 1] - self.first[at]
        begin = np.cumsum(n) - n
        item = self.members[np.repeat(self.first[at] - begin, n) + np.arange(int(n.sum()))]
        doc = np.repeat(doc, n)
        found = np.unique(doc * len(self.ids) + item)
        out, row, held = [], -1, set()
        for pair in found.tolist():
            d, i = divmod(pair, len(self.ids))
            if d != row:
                row, held = d, _shingle_set(w.words_of(d), self.shingle)
            shared = len(self.sets[i] & held)
            if shared >= _needed(self.threshold, len(self.sets[i])):
                out.append((d, i, shared))
        return out


def _blocks(benchmark: DataFrame, block_items: int, shingle: int, threshold: float) -> Iterator[Index]:
    held = []
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        held.append((r[0], r[1]))
        if len(held) == block_items:
            yield Index.build(held, shingle, threshold)
            held = []
    if held:
        yield Index.build(held, shingle, threshold)


def pairs(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, block_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) at the threshold or above."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], _PAIRS)
    for index in _blocks(benchmark, block_items, shingle, threshold):
        out = out.unionByName(rows.mapInArrow(_pairs_of(spark.sparkContext.broadcast(index)), _PAIRS))
    return out


def _pairs_of(held):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            index = held.value
            found = index.matches(part.column("text"))
            ids = part.column("doc_id").to_pylist() if found else []
            size = [len(index.sets[i]) for _, i, _ in found]
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[d] for d, _, _ in found], pa.int64()), pa.array([index.ids[i] for _, i, _ in found], pa.int64()),
                pa.array(size, pa.int64()), pa.array([s for _, _, s in found], pa.int64()),
                pa.array([s / n for (_, _, s), n in zip(found, size)], pa.float64())],
                names=[x.split()[0] for x in _PAIRS.split(", ")])
    return scan


def _clean_of(held):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keep = np.ones(part.num_rows, bool)
            keep[[d for d, _, _ in held.value.matches(part.column("text"))]] = False
            yield part.filter(pa.array(keep))
    return scan


def clean(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, threshold: float = 0.8, block_items: int = 20_000) -> DataFrame:
    """The input rows that contain no benchmark item, unchanged."""
    for index in _blocks(benchmark, block_items, shingle, threshold):
        docs = docs.mapInArrow(_clean_of(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_shingles(table: str, key: str) -> str:
    return f"""
  SELECT rid, {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END) AS s
  FROM (SELECT row_number() OVER () AS rid, {key},
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table})"""


ORACLE = f"""
WITH d AS ({_sql_shingles('documents', 'doc_id')}),
b AS ({_sql_shingles('benchmark', 'item_id')}),
n AS (SELECT rid, count(*) AS n_shingles FROM b GROUP BY rid),
c AS (SELECT d.rid AS d_rid, b.rid AS b_rid, any_value(doc_id) AS doc_id, any_value(item_id) AS item_id, count(*) AS n_shared
      FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM c JOIN n ON n.rid = b_rid WHERE 5 * n_shared >= 4 * n_shingles
"""
