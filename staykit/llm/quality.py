"""Quality rules from repetition coverage.

Words ``[^\\x20\\x09-\\x0D]+`` are hashed, and rolling hashes of several n-gram
lengths are sorted within their document, all in numpy over a slice of texts.
Coverage of a length is the share of word characters inside n-grams found
twice or more in the text (first occurrence included); line coverage is the
share of word characters in lines equal to an earlier line. A longer n-gram
can only repeat where its 3-grams repeat, so lengths after the first look at
those places alone.

A document fails if it has fewer than ``least_words`` words, if over half its
words lie in repeated 3-word windows, if a length's coverage exceeds its
limit, if the lines' does, or if it has more than ``most_symbols`` markup
symbols a word.

Edge cases: null text is empty (no words: fails on length); repeated rows
and null ids are rows like any other; a very long text is one slice, whole;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import M64, Words, mix, owner, slices, span_hash

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Most coverage a kept document may have, by n-gram length; 0 stands for lines.
LIMITS = {3: 0.50, 5: 0.35, 10: 0.30, 0: 0.30}
_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, coverage_3 double, coverage_5 double, coverage_10 double, "
           "coverage_lines double")


def _repeated(h: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more."""
    out = np.zeros(len(h), bool)
    if len(h) > 1:
        order = np.argsort(h)
        same = h[order[1:]] == h[order[:-1]]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def _cover(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside the n-word windows at ``starts``."""
    step = np.zeros(words + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(column: pa.Array, lengths: tuple[int, ...] = (3, 5, 10)) -> dict[str, np.ndarray]:
    """Counts and coverages of each text of a column."""
    w = Words(column, lower=False)
    n, k = w.n_docs, len(w.hash)
    lead = np.cumsum(np.concatenate([[0], (w.raw & 0xC0) != 0x80]))       # code points before each byte
    chars = lead[w.ends] - lead[w.starts]

    def per_doc(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n).astype(np.int64)

    total = per_doc(chars, w.doc)
    symbols = np.flatnonzero(SYMBOLS[w.raw])
    out = {"n_words": w.count.astype(np.int64), "word_chars": total,
           "n_symbols": np.bincount(owner(symbols, w.offsets), minlength=n).astype(np.int64)}

    salt = mix(w.doc.astype(np.uint64) + np.uint64(1))
    places, repeat = None, np.zeros(k + 1, np.int64)
    for length in lengths:
        at = np.arange(max(0, k - length + 1))
        if places is not None:                              # every 3-gram inside must repeat
            at = at[repeat[at + length - lengths[0] + 1] - repeat[at] == length - lengths[0] + 1]
        at = at[w.doc[at] == w.doc[at + length - 1]]
        h = salt[at].copy()
        for j in range(length):
            h = h * M64 + w.hash[at + j]
        at = at[_repeated(mix(h))]
        if places is None:
            places = at
            hit = np.zeros(k, np.int64)
            hit[at] = 1
            repeat = np.concatenate([[0], np.cumsum(hit)])
        inside = _cover(at, length, k)
        out[f"words_{length}"] = per_doc(inside, w.doc)
        out[f"chars_{length}"] = per_doc(chars * inside, w.doc)

    # lines that hold a word and equal an earlier line
    newline = w.raw == 10
    is_end = newline.copy()
    ends = w.offsets[1:][np.diff(w.offsets) > 0]
    cuts = np.unique(np.concatenate([np.flatnonzero(is_end) + 1, ends, [0]])) if len(w.raw) else np.zeros(1, np.int64)
    starts, stops = cuts[:-1], cuts[1:]
    stops = stops - newline[stops - 1] if len(starts) else stops
    first, last = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, stops)
    full = last > first
    starts, stops, first, last = starts[full], stops[full], first[full], last[full]
    doc = owner(starts, w.offsets)
    h = mix(span_hash(w.raw, starts, stops) + mix(doc.astype(np.uint64) + np.uint64(1)))
    later = np.zeros(len(h), bool)
    if len(h) > 1:
        order = np.argsort(h, kind="stable")
        later[order[1:]] = h[order[1:]] == h[order[:-1]]
    out["n_dup_lines"] = np.bincount(doc[later], minlength=n).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(chars)])
    out["chars_lines"] = per_doc((before[last] - before[first]) * later, doc)
    return out


def rules(docs: DataFrame, least_words: int = 50, limits: dict[int, float] | None = None,
          most_symbols: float = 0.25) -> DataFrame:
    """Per row: counts, coverages, ``base_failed`` and ``kept``."""
    limits = LIMITS if limits is None else limits
    lengths = tuple(sorted(n for n in limits if n))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            m = measure(part.column("text"), lengths)
            share = {n: m[f"chars_{n or 'lines'}"] / np.maximum(m["word_chars"], 1) for n in limits}
            failed = (m["n_words"] < least_words) | (100 * m["words_3"] > 50 * m["n_words"])
            kept = ~failed & (m["n_symbols"] <= most_symbols * m["n_words"])
            for n, most in limits.items():
                kept &= share[n] <= most
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id")] + [pa.array(x) for x in (
                    m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["words_3"], failed, kept,
                    share[3], share[5], share[10], share[0])],
                names=[x.split()[0] for x in _SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, _SCHEMA)
