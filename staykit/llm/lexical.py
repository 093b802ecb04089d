"""Ranked lexical search: dense blocked matrix products over impact scores.

Items are the queries, documents what is ranked. Two passes over the documents:

1. corpus statistics: the number N of documents with a term, the number L of
   all terms and, for the terms of the items, the number of documents that
   hold them; each task sends one row a term at most;
2. scores: of each batch of documents the terms of the items are counted
   and turned into integer impacts. Items come in tiles; a tile has a compact
   vocabulary (its own terms), and its float64 matrix of item by term (weight
   times occurrences in the item) is multiplied by BLAS with the matrix of
   term by document (impacts). A vocabulary is cut so that no sum of a
   product can reach 2^53, so every partial sum is an exact integer in
   whatever order BLAS adds; the parts are added up as 64-bit integers.

Of each tile of documents an item's best are taken by (score descending,
document id ascending): everything that ties with the k-th score stays in
until the ids decide. A task keeps k rows an item, however many documents it
reads, and a grouped limit picks the first k of all.

The items are a stated query set: they are read in blocks of ``block_items``,
each broadcast with its vocabulary, and every block meets all documents.
Nothing but statistics and candidates is shuffled.

Terms are ASCII letters and digits and everything above ASCII, A-Z
lower-cased. Edge cases: null or blank items and documents have no terms,
such items have no rows; a repeated item or document is an item or document
of its own (repeated items with one id share their ranks: ranks are by row of
the item table); null document ids come last among ties; equal ids of equal
score are ranked in any order; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernel import slices

#: Float64 holds every integer below this.
EXACT = 1 << 53
#: Impacts are at most this (a term that fills a document).
MOST_IMPACT = 1_000_000
ITEM_TILE, DOC_TILE = 256, 1024

# what separates terms becomes a space, A-Z become a-z
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_NULL_LAST = np.iinfo(np.int64).max


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text, in order."""
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(_TERMS).split()


@dataclass
class Block:
    """Some items with the numbers of their terms."""

    rows: list[tuple[int, int | None, list[bytes]]]             # (row number, item_id, terms)
    number: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self):
        for _, _, words in self.rows:
            for w in words:
                self.number.setdefault(w, len(self.number))


def blocks(items: DataFrame, block_items: int) -> Iterator[Block]:
    held, n = [], 0
    for r in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        words = terms(r[1])
        if words:
            held.append((n, r[0], words))
            n += 1
        if len(held) == block_items:
            yield Block(held)
            held = []
    if held:
        yield Block(held)


def counted(column: pa.Array, number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms a document, then document, term, occurrences of the numbered terms)."""
    size, found, lengths = [], [], []
    get = number.get
    for text in column.cast(pa.large_binary()).to_pylist():
        words = terms(text)
        size.append(len(words))
        own = [n for n in map(get, words) if n is not None]
        found.append(np.array(own, np.int64))
        lengths.append(len(own))
    doc = np.repeat(np.arange(len(size)), lengths)
    term = np.concatenate(found) if found else np.zeros(0, np.int64)
    key, times = np.unique(doc * max(1, len(number)) + term, return_counts=True)
    doc, term = np.divmod(key, max(1, len(number)))
    return np.array(size, np.int64), doc, term, times


def statistics(docs: DataFrame, block: Block) -> DataFrame:
    """``term, n``: document counts of the block's terms; under -1 the
    documents with a term, under -2 all their terms."""
    held = docs.sparkSession.sparkContext.broadcast(block.number)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = held.value
        total = np.zeros(len(number), np.int64)
        n_docs = n_terms = 0
        for part in slices(batches, "text"):
            size, _, term, _ = counted(part.column("text"), number)
            total += np.bincount(term, minlength=len(number))
            n_docs += int((size > 0).sum())
            n_terms += int(size.sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2])), pa.array(np.append(total[at], [n_docs, n_terms]))], names=["term", "n"])

    return docs.mapInArrow(scan, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def weight(n_docs: int, held_by: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held_by + 1)))


@dataclass
class Index:
    """A block's items as tiles, with the corpus statistics."""

    number: dict[bytes, int]
    ids: list[tuple[int, int | None]]
    tiles: list[Tile]
    n_docs: int
    n_terms: int
    k: int


@dataclass
class Tile:
    """Some items and one cut of their vocabulary after the other."""

    first: int                                          # of the block's items
    parts: list[tuple[np.ndarray, np.ndarray]]          # (terms, matrix of item by term)


def tile(first: int, rows: list[list[int]], weights: np.ndarray) -> Tile:
    """The items' matrix, cut where an item's sums could reach 2^53."""
    vocabulary = np.unique(np.concatenate([np.array(r, np.int64) for r in rows]))
    full = np.zeros((len(rows), len(vocabulary)), np.int64)
    for i, r in enumerate(rows):
        np.add.at(full[i], np.searchsorted(vocabulary, r), 1)
    full *= weights[vocabulary]
    parts, at, cap = [], 0, EXACT // (2 * MOST_IMPACT)
    while at < len(vocabulary):
        while full[:, at].max() > cap:                              # one term alone reaches the limit: in several parts
            parts.append((vocabulary[at:at + 1], np.minimum(full[:, at:at + 1], cap).astype(np.float64)))
            full[:, at] -= np.minimum(full[:, at], cap)
        # the greatest sum of a row up to each term, if all impacts were the greatest
        most = np.cumsum(full[:, at:], axis=1).max(axis=0) * float(MOST_IMPACT)
        to = at + max(1, int(np.searchsorted(most, float(EXACT) / 2)))
        parts.append((vocabulary[at:to], full[:, at:to].astype(np.float64)))
        at = to
    return Tile(first, parts)


def index(block: Block, stats: dict[int, int], k: int) -> Index:
    n_docs, n_terms = stats.get(-1, 0), stats.get(-2, 0)
    weights = np.array([weight(n_docs, stats.get(t, 0)) for t in range(len(block.number))], np.int64)
    rows = [[block.number[w] for w in words] for _, _, words in block.rows]
    tiles = [tile(a, rows[a:a + ITEM_TILE], weights) for a in range(0, len(rows), ITEM_TILE)]
    return Index(block.number, [(r, i) for r, i, _ in block.rows], tiles, n_docs, n_terms, k)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k greatest positive scores, ties by least id."""
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None]
        may = (score >= np.maximum(least, 1))
    else:
        may = score > 0
    row, column = np.nonzero(may)
    order = np.lexsort((ids[column], -score[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def impacts(tf: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``(10^9 tf) div (1000 tf + 12 m)`` of each occurrence count; size: terms of its document."""
    m = 100 - 25 + (25 * size * n_docs) // max(1, n_terms)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


_FOUND = "item long, doc_id long, score long"


def _search(held):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = held.value
        kept = [(np.zeros(0, np.int64),) * 3] * len(ix.tiles)          # item in the tile, score, id
        for part in slices(batches, "text"):
            size, doc, term, tf = counted(part.column("text"), ix.number)
            value = impacts(tf, size[doc], ix.n_docs, ix.n_terms)
            ids = part.column("doc_id").fill_null(_NULL_LAST).to_numpy(zero_copy_only=False)
            for a in range(0, len(size), DOC_TILE):
                low, high = np.searchsorted(doc, [a, a + DOC_TILE])
                d, t, v = doc[low:high] - a, term[low:high], value[low:high]
                n = min(DOC_TILE, len(size) - a)
                for j, tile_ in enumerate(ix.tiles):
                    score = None
                    for vocabulary, matrix in tile_.parts:
                        at = np.minimum(np.searchsorted(vocabulary, t), len(vocabulary) - 1)
                        own = vocabulary[at] == t
                        dense = np.zeros((len(vocabulary), n))
                        dense[at[own], d[own]] = v[own]
                        there = np.flatnonzero(dense.any(axis=1))       # terms that no document here has add nothing
                        product = (matrix[:, there] @ dense[there]).astype(np.int64)
                        score = product if score is None else score + product
                    row, column = best(score, ids[a:a + n], ix.k)
                    item, own_score, own_id = kept[j]
                    kept[j] = _first(np.append(item, row), np.append(own_score, score[row, column]), np.append(own_id, ids[a + column]), ix.k)
        for tile_, (item, score, doc_id) in zip(ix.tiles, kept):
            yield pa.RecordBatch.from_arrays([
                pa.array(item + tile_.first), pa.array(doc_id, pa.int64(), mask=doc_id == _NULL_LAST), pa.array(score)],
                names=["item", "doc_id", "score"])
    return scan


def _first(item, score, doc_id, k):
    order = np.lexsort((doc_id, -score, item))
    item, score, doc_id = item[order], score[order], doc_id[order]
    keep = np.arange(len(item)) - np.searchsorted(item, item) < k
    return item[keep], score[keep], doc_id[keep]


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_items: int = 20_000) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for block in blocks(items, block_items):
        stats = {r[0]: r[1] for r in statistics(rows, block).toLocalIterator()}       # at most a row a term of the block
        ix = index(block, stats, k)
        found = rows.mapInArrow(_search(spark.sparkContext.broadcast(ix)), _FOUND)
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(j, i) for j, (_, i) in enumerate(ix.ids)], "item int, item_id long")
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))   # a row an item of the block
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_terms(table: str, key: str) -> str:
    return f"""SELECT rid, {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM (SELECT row_number() OVER () AS rid, {key}, text FROM {table})"""


ORACLE = f"""
WITH d AS ({_sql_terms('documents', 'doc_id')}),
i AS (SELECT rid AS i_rid, item_id, t, count(*) AS q FROM ({_sql_terms('benchmark', 'item_id')}) GROUP BY ALL),
s AS (SELECT rid, doc_id, count(*) AS n FROM d GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM s),
m AS (SELECT rid, doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM s, c),
f AS (SELECT rid, t, count(*) AS tf FROM d WHERE t IN (SELECT t FROM i) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t),
r AS (SELECT i_rid, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
             sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM i JOIN w USING (t) JOIN f USING (t) JOIN m USING (rid) GROUP BY i_rid, rid),
k AS (SELECT *, row_number() OVER (PARTITION BY i_rid ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""
