"""Periodic runs of words, by recompression.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)``
words long, that no neighbouring word extends. Any run holds four points of
the grid of its own period (the multiples of q), so the candidates are the
places where four successive grid points hold the same word. All grids of a
document together have n(1 + 1/2 + 1/3 + ...) points.

How far a candidate extends is answered exactly by a run-length grammar of the
words. It is built by recompression: in turn, each maximal block ``a a ... a``
becomes one symbol, and each pair ``ab`` with a from one and b from the other
half of the symbols becomes one symbol, until a document is one symbol. Equal
symbols stand for equal words, and equal stretches are cut alike but for their
ends. A longest common extension climbs the levels, matching a block or one
symbol where two places aren't both at the edge of a symbol of the next
level, until two symbols differ, and then goes down to the words; each level
takes one step. No suffix array is built.

Periods are taken in ranges of q to 2q - 1, the shortest first. No period in a
range divides another one, and a candidate inside a run whose period divides
its own is that run again (Fine and Wilf), so it is dropped unasked; documents
without candidates get no grammar.

The work is a scan: batches of some megabytes, numpy over all their documents
at once; a document is never split, and nothing is shuffled.

Words are ``[^\\x20\\x09-\\x0D]+``. Edge cases: null, empty and blank texts have
no words and no runs, and an empty collapsed text; repeated rows and null ids
are rows like any other; two words are the same if their bytes are; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import slices

#: Least words of a run, and least periods.
LEAST, TIMES = 6, 4
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Grammar:
    """Levels of a recompression: symbols, and for each next level its children.

    ``words`` are documents of numbered words one after the other, each closed
    by a number of its own (``last``: at which places), which never matches.
    """

    def __init__(self, words: np.ndarray, last: np.ndarray):
        self.symbols = [words]
        self.parent: list[np.ndarray] = []              # index of a symbol's parent in the next level
        self.first: list[np.ndarray] = []               # index of a parent's first child
        self.final: list[np.ndarray] = []               # and of its last one
        self.block: list[bool] = []                     # whether blocks or pairs made the next level
        self.rules: list[tuple[int, np.ndarray, np.ndarray]] = []   # lowest number; of a block symbol and power, of a pair both
        self.next = int(words.max()) + 1 if len(words) else 0
        closes = np.zeros(len(words), bool)
        closes[last] = True
        turn = 0
        while len(self.symbols[-1]) > len(last):
            s = self.symbols[-1]
            new = np.ones(len(s), bool)
            new[1:] = s[1:] != s[:-1]
            first = np.flatnonzero(new)
            if len(first) < len(s):
                power = np.diff(np.append(first, len(s)))
                closes = self._level(s, first, power > 1, s[first], power, closes, block=True)
            closes = self._pairs(closes, turn)
            turn += 1

    def _level(self, s, first, made, left, right, closes, block: bool) -> np.ndarray:
        """Add the level whose symbols begin at ``first``; those ``made`` are new: (left, right)."""
        key = (left[made].astype(np.int64) << 32) | right[made]
        rules, name = np.unique(key, return_inverse=True)
        out = s[first]
        out[made] = self.next + name
        self.rules.append((self.next, rules >> 32, rules & 0xFFFFFFFF))
        self.block.append(block)
        self.next += len(rules)
        final = np.append(first[1:], len(s)) - 1
        self.parent.append(np.repeat(np.arange(len(first)), final - first + 1))
        self.first.append(first)
        self.final.append(final)
        self.symbols.append(out)
        return closes[final]

    def _pairs(self, closes: np.ndarray, turn: int) -> np.ndarray:
        s = self.symbols[-1]
        mixed = (s.astype(np.uint64) + np.uint64(2 * turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
        half = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 1
        inner = ~closes[:-1]
        one, two = half[:-1] & ~half[1:] & inner, half[1:] & ~half[:-1] & inner
        at = one if one.sum() >= two.sum() else two
        if not at.any():
            return closes
        begins = np.ones(len(s), bool)
        begins[1:] = ~at
        first = np.flatnonzero(begins)
        made = np.append(at, False)[first]
        right = s[np.minimum(first + 1, len(s) - 1)]
        return self._level(s, first, made, s[first], right, closes, block=False)

    def extension(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many words from x and from y on are the same, going by ``step`` (1 or -1)."""
        top = len(self.parent)
        x, y, begin = x.copy(), y.copy(), x
        stop = np.full(len(x), top)                     # level at which two symbols differ
        live = np.arange(len(x))
        near, far = (self.first, self.final) if step > 0 else (self.final, self.first)
        for k in range(top):
            if not len(live):
                break
            a, b, s = x[live], y[live], self.symbols[k]
            pa_, pb = self.parent[k][a], self.parent[k][b]
            inside = (near[k][pa_] != a) | (near[k][pb] != b)
            same = s[a] == s[b]
            left_a, left_b = np.abs(far[k][pa_] - a) + 1, np.abs(far[k][pb] - b) + 1
            move = np.where(inside & same, np.minimum(left_a, left_b), 0)
            a, b = a + step * move, b + step * move
            differ = inside & (~same | (left_a != left_b))
            x[live], y[live] = np.where(differ, a, self.parent[k][a]), np.where(differ, b, self.parent[k][b])
            stop[live[differ]] = k
            live = live[~differ]
        for k in range(top - 1, -1, -1):
            down = np.flatnonzero(stop > k)
            if not len(down):
                continue
            a, b, s = near[k][x[down]], near[k][y[down]], self.symbols[k]
            # of two blocks the common part is the same, of two pairs one symbol; what follows differs
            left = np.minimum(np.abs(far[k][x[down]] - a), np.abs(far[k][y[down]] - b)) + 1 if self.block[k] else 1
            move = np.where(s[a] == s[b], left, 0)
            x[down], y[down] = a + step * move, b + step * move
        return np.abs(x - begin)


def _grid(words: np.ndarray, ends: np.ndarray, lengths: np.ndarray, q: int) -> np.ndarray:
    """Multiples of q at which four successive grid points hold one word.

    The documents (longest first) that are too short for q are left out.
    """
    n = int(np.searchsorted(-lengths, -max(LEAST, TIMES * q), side="right"))
    if not n:
        return np.zeros(0, np.int64)
    points = words[:ends[n - 1] + 1:q]
    same = points[1:] == points[:-1]
    return np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each array of word numbers, by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    starts = 1 + np.cumsum(lengths + 1) - (lengths + 1)
    ends = starts + lengths                             # where the closing numbers are
    most = max((int(t.max()) for t in texts if len(t)), default=0)
    words = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    words[0] = most + 1
    for d, at, z in zip(order, starts, ends):
        words[at:z] = texts[d]
    words[ends] = most + 2 + np.arange(len(ends))
    cover_end, cover_period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    found: set[tuple[int, int]] = set()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    low, longest = 1, int(lengths[0]) if len(lengths) else 0
    while TIMES * low <= longest:
        grids = [(q, _grid(words, ends, lengths, q)) for q in range(low, min(2 * low, longest // TIMES + 1))]
        place = np.concatenate([g for _, g in grids])
        period = np.repeat([q for q, _ in grids], [len(g) for _, g in grids])
        low *= 2
        ask = place + 3 * period < ends[np.minimum(np.searchsorted(ends, place), len(ends) - 1)]        # all in one document
        ask &= (period % cover_period[place] != 0) | (place + period >= cover_end[place])
        place, period = place[ask], period[ask]
        if not len(place):
            continue
        docs = np.unique(np.searchsorted(ends, place))
        size = ends[docs] - starts[docs] + 1
        base = 1 + np.cumsum(size) - size
        own = np.concatenate([words[:1], *[words[starts[d]:ends[d] + 1] for d in docs]])
        _, own = np.unique(own, return_inverse=True)
        grammar = Grammar(own.astype(np.int64), np.append(0, base + size - 1))
        shift = (base - starts[docs])[np.searchsorted(docs, np.searchsorted(ends, place))]
        for last in (False, False, True):
            if not len(place):
                break
            # of each chain of neighbouring candidates the first one, twice; then all that are not explained yet
            chain = np.ones(len(place), bool)
            if not last:
                chain[1:] = (period[1:] != period[:-1]) | (place[1:] - place[:-1] != period[1:])
            x, q, s = place[chain], period[chain], shift[chain]
            forth = grammar.extension(x + s, x + s + q, 1)
            back = grammar.extension(x + s - 1, x + s + q - 1, -1)
            begin, end = x - back, x + q + forth
            for b, e, p in zip(begin.tolist(), end.tolist(), q.tolist()):
                if e - b >= max(LEAST, TIMES * p) and (b, e) not in found:
                    found.add((b, e))
                    cover_end[b:e], cover_period[b:e] = e, p
                    d = int(np.searchsorted(ends, b))
                    out[order[d]].append((b - int(starts[d]), e - b, p))
            rest = place + period >= end[np.cumsum(chain) - 1]
            place, period, shift = place[rest], period[rest], shift[rest]
    for r in out:
        r.sort(key=lambda t: (t[0], t[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for part in slices(batches, "text", 4 << 20):
        texts = [(t or b"").split() for t in part.column("text").cast(pa.large_binary()).to_pylist()]
        number = {w: i for i, w in enumerate(set().union(*texts))}
        numbered = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
        runs = runs_of(numbered)
        yield pa.RecordBatch.from_arrays([
            part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], kind),
            pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, runs)], pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
        ], names=["doc_id", "n_words", "runs", "collapsed"])


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period), collapsed (the kept words, joined by a space)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Of :func:`find`: doc_id, n_runs, the run of the greatest exponent, and the digests."""
    better = F.reduce(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", better).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
