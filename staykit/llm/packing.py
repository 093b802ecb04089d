"""Packing token pieces into sequences: best fit, then swap-based local search.

A document is its token ids and the end id. One longer than ``size`` is cut
into pieces of ``size`` ids, the first piece taking the remainder; nothing
else is cut. Full pieces stand alone. The others are dealt at random (by id
hash) into cells of bounded size, and each cell is packed by itself: pieces
go best-fit-decreasing; then bins below ``size`` exchange pieces one for one,
two for one, or move a piece, whenever that raises the sum of squared fills.
Fuller bins get fuller and the emptiest one is drained until it is gone; the
search ends when no exchange helps or the cell's bins equal the lower bound.
A cell wastes at most its last bins, so cells cost nothing at scale.

Only piece lengths travel; ids are reduced to a checksum where they are made.

Edge cases: null text is empty (one piece, the end id); repeated rows and
null ids are pieces of their own; a very long text is encoded whole; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .kernel import slices

#: Beyond Latin letters the two libraries' Unicode tables may differ by version.
_PLAIN = re.compile("[\x00-ɏ‐-…€]*")


class Encoder:
    """ids of the ``tokenizers`` file, by its byte-level BPE ranks where those give the same.

    The rank file holds the same vocabulary and encodes five times as fast.
    Texts with other than Latin characters take the ``tokenizers`` library.
    Strings of special tokens in a text are those tokens, as the file has it.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self._slow, self._fast = path, None, None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            with open(path, encoding="utf-8") as file:
                self._special = [t["content"] for t in json.load(file).get("added_tokens", [])]

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if self._fast is not None and _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
            return self._fast.encode_ordinary(text)
        return self.slow(text)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None,
           size: int = 1024, end: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every row."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for part in slices(batches, "text"):
            encode = encode or Encoder(path, ranks, pattern)
            out = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = np.array([*(encode(text) if text else []), end], "<u4")
                cut = (len(ids) % size or size) if len(ids) > size else len(ids)
                starts = [0, *range(cut, len(ids), size)]
                for i, (a, z) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((doc, i, a, z - a, zlib.crc32(ids[a:z].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=[x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, _PIECES)


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of piece indices, best-fit-decreasing by remaining room."""
    room: list[list[list[int]]] = [[] for _ in range(size + 1)]
    used = 0                                                 # bit r: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = used >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1          # tightest room that holds it
            bin_ = room[r].pop()
            if not room[r]:
                used &= ~(1 << r)
        else:
            r, bin_ = size, []
        bin_.append(i)
        room[r - n].append(bin_)
        used |= 1 << (r - n)
    return [b for bins in room for b in bins]


class _Index:
    """Which fills hold a piece, or two pieces, of a given sum.

    ``best[k][m, f]`` is the largest fill up to f of a bin that holds k + 1
    pieces of m ids in all, -1 if there is none. Row 0 of ``best[0]`` is any bin.
    """

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros((2, size + 1, size + 1), np.int32)
        self.best = np.full((2, size + 1, size + 1), -1, np.int16 if size < 1 << 15 else np.int32)
        self.fills = np.arange(size + 1)
        self.at: dict[int, set[int]] = {}

    def change(self, bin_: int, fill: int, sums: list[np.ndarray], by: int) -> None:
        for k, rows in enumerate((np.append(sums[0], 0), sums[1])):
            if len(rows):
                self.count[k, rows, fill] += by
                self.best[k, rows] = np.maximum.accumulate(np.where(self.count[k, rows] > 0, self.fills, -1), axis=1)
        (self.at.setdefault(fill, set()).add if by > 0 else self.at[fill].discard)(bin_)


def _sums(lengths: np.ndarray) -> list[np.ndarray]:
    """Distinct lengths of a bin's pieces, and distinct sums of two of them."""
    one, n = np.unique(lengths, return_counts=True)
    i, j = np.triu_indices(len(one), 1)
    return [one, np.unique(np.concatenate([one[i] + one[j], 2 * one[n > 1]]))]


def _take(bin_: list[int], lengths: np.ndarray, total: int, two: bool) -> list[int]:
    """One piece of that length, or two of that sum."""
    if not two:
        return [next(i for i in bin_ if lengths[i] == total)] if total else []
    seen: dict[int, int] = {}
    for i in bin_:
        n = int(lengths[i])
        if total - n in seen:
            return [seen[total - n], i]
        seen[n] = i
    return []


def _climb(open_: list[list[int]], lengths: np.ndarray, size: int, spare: int) -> None:
    """Exchange pieces in place until no exchange helps or ``spare`` bins are empty.

    Bin a gives n ids for m fewer of bin b, d = n - m > 0: squared fill grows
    if b's fill is above a's less d. Of all such exchanges a's best is made.
    """
    fill = [int(lengths[b].sum()) for b in open_]
    sums = [_sums(lengths[b]) for b in open_]
    index = _Index(size)
    for b in range(len(open_)):
        if fill[b] < size:                                  # a full bin neither gives nor takes
            index.change(b, fill[b], sums[b], 1)
    changed = True
    while changed and spare > 0:
        changed = False
        for a in sorted(range(len(open_)), key=lambda b: fill[b]):
            if not 0 < fill[a] < size or spare <= 0:
                continue
            index.change(a, fill[a], sums[a], -1)
            while fill[a]:
                found = (0, 0, 0, 0, 0, 0)
                for give, get in ((0, 0), (1, 0), (0, 1)):
                    n, m = sums[a][give][:, None], np.arange(size)[None, :]
                    d = n - m
                    f = np.where(d > 0, index.best[get][m, np.clip(size - d, 0, size)], -1).astype(np.int64)
                    gain = np.where((f >= 0) & (f > fill[a] - d), d * (f - fill[a] + d), 0)
                    if gain.size and gain.max() > found[0]:
                        x, y = np.unravel_index(gain.argmax(), gain.shape)
                        found = (int(gain[x, y]), give, get, int(n[x, 0]), int(y), int(f[x, y]))
                gain, give, get, n, m, f = found
                if not gain:
                    break
                b = next(b for b in index.at[f] if not m or m in sums[b][get])
                out, back = _take(open_[a], lengths, n, give == 1), _take(open_[b], lengths, m, get == 1)
                index.change(b, fill[b], sums[b], -1)
                for bin_, less, more in ((a, out, back), (b, back, out)):
                    open_[bin_] = [i for i in open_[bin_] if i not in less] + more
                    fill[bin_] = int(lengths[open_[bin_]].sum()) if open_[bin_] else 0
                    sums[bin_] = _sums(lengths[open_[bin_]]) if open_[bin_] else [np.zeros(0, np.int64)] * 2
                if fill[b] < size:
                    index.change(b, fill[b], sums[b], 1)
                changed = True
            if fill[a]:
                index.change(a, fill[a], sums[a], 1)
            else:
                spare -= 1


def improve(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Swap-based local search: raise the sum of squared fills until no exchange does.

    A move takes one piece; an exchange swaps one for one or two for one,
    either way round. Then what is left below ``size`` is packed anew, and
    searched again if that saves a bin.
    """
    lengths = np.asarray(lengths, np.int64)
    least = -(-int(lengths.sum()) // size)
    bins = [b for b in bins if b]
    while len(bins) > least:
        full = [b for b in bins if lengths[b].sum() == size]
        open_ = [list(b) for b in bins if lengths[b].sum() < size]
        _climb(open_, lengths, size, len(bins) - least)
        bins = full + [b for b in open_ if b]
        left = [b for b in bins if lengths[b].sum() < size]
        loose = [i for b in left for i in b]
        anew = [[loose[i] for i in b] for b in best_fit(lengths[loose], size)] if loose else []
        if len(anew) >= len(left):
            break
        bins = [b for b in bins if lengths[b].sum() == size] + anew
    return bins


def pack(docs: DataFrame, path: str, ranks: str | None = None, pattern: str | None = None,
         size: int = 1024, end: int = 2, cell_pieces: int = 20_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    checkpoint_root(docs.sparkSession)
    cut = pieces(docs, path, ranks, pattern, size, end).checkpoint()
    n_cells = max(1, -(-cut.where(F.col("length") < size).count() // cell_pieces))
    schema = f"{_PIECES}, sequence_id long, offset long"

    def cell(key, table):
        table = table.drop_columns(["cell"]).sort_by([("length", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_numpy()
        bins = improve(best_fit(lengths, size), lengths, size)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, b in enumerate(bins):
            sequence[b] = (key[0].as_py() << 32) | n
            offset[b] = np.cumsum(lengths[b]) - lengths[b]
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    # a full piece is a sequence; its id is above those of the cells
    full = cut.where(F.col("length") == size).withColumn(
        "sequence_id", F.lit(n_cells << 32) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = cut.where(F.col("length") < size).withColumn("cell", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(n_cells)).cast("long"))
    return dealt.groupBy("cell").applyInArrow(cell, schema).unionByName(full)
