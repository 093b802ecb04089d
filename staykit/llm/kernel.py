"""Vectorised text kernels shared by the operators of this subpackage.

Everything here works on one Arrow batch inside a task: the UTF-8 bytes of
the batch's texts in one numpy buffer with document offsets. No function
keeps state between batches, so memory is bounded by the batch.

A word is ``[^\\x20\\x09-\\x0D]+``. A null text is an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

M64 = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * M64)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
        column = column.fill_null("")
    else:
        column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal True runs, cut at document offsets."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(mask)]
    first[cuts] = mask[cuts]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    ends = offsets[1:] - 1
    ends = ends[ends >= 0]
    last[ends] = mask[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owner(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the document that holds each position."""
    return np.searchsorted(offsets, starts, side="right") - 1


_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd multiplier modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        out = np.full(max(n, 1024), M64, np.uint64)
        out[0] = 1
        _POWERS = np.multiply.accumulate(out)
    return _POWERS[:n]


_CHUNK = 1 << 18


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty span, in chunks that stay in the cache."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    length = ends - starts
    until = np.cumsum(length)
    cuts = np.unique(np.append(np.searchsorted(until, np.arange(0, int(until[-1]), _CHUNK)), len(starts)))
    place_of = powers(int(length.max()))
    for a, z in zip(cuts[:-1], cuts[1:]):
        n = length[a:z]
        at = until[a:z] - n
        at -= at[0]
        back = np.repeat(starts[a:z] - at, n)
        step = np.arange(len(back))
        value = _BYTE[buf[back + step]]
        value *= place_of[step - np.repeat(at, n)]
        out[a:z] = np.add.reduceat(value, at)
    return mix(out + length.astype(np.uint64) * M64)


class Words:
    """The words of a batch: byte spans, owning document, 64-bit hashes."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = True, space: np.ndarray = SPACE):
        self.raw, self.offsets = text_buffer(column)
        self.n_docs = len(self.offsets) - 1
        self.buf = LOWER[self.raw] if lower else self.raw
        self.starts, self.ends = runs(~space[self.raw], self.offsets)
        self.doc = owner(self.starts, self.offsets)
        self.hash = span_hash(self.buf, self.starts, self.ends)
        #: index of each document's first word, with one entry past the end
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        self.count = np.diff(self.first)

    def shingles(self, n: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, document, first word) of every n-word window, in text order.

        A document with fewer than n words (and at least one) gives one
        shingle of all its words if ``whole_if_short``.
        """
        k = len(self.hash)
        if k >= n:
            h = np.zeros(k - n + 1, np.uint64)
            for j in range(n):
                h = h * M64 + self.hash[j:k - n + 1 + j]
            keep = self.doc[:k - n + 1] == self.doc[n - 1:]
            at = np.flatnonzero(keep)
            h, doc = mix(h[at] + np.uint64(n)), self.doc[at]
        else:
            at, h, doc = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if not whole_if_short:
            return h, doc, at
        short = np.flatnonzero((self.count > 0) & (self.count < n))
        if len(short):
            extra = []
            for d in short:
                v = np.uint64(0)
                with np.errstate(over="ignore"):
                    for x in self.hash[self.first[d]:self.first[d + 1]]:
                        v = v * M64 + x
                    extra.append(v + np.uint64(self.count[d]))
            h = np.concatenate([h, mix(np.array(extra, np.uint64))])
            doc = np.concatenate([doc, short])
            at = np.concatenate([at, self.first[short]])
            order = np.argsort(at, kind="stable")
            h, doc, at = h[order], doc[order], at[order]
        return h, doc, at

    def words_of(self, d: int) -> list[bytes]:
        """The words of one document, as bytes (lower-cased if asked for)."""
        return self.buf[self.offsets[d]:self.offsets[d + 1]].tobytes().split()


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches whose texts hold about ``most`` bytes at most.

    A single longer text is a slice of its own, whole.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(batch.num_rows, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
