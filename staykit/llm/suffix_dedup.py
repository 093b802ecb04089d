"""Exact removal of repeated byte passages: a logarithmic suffix-array family.

A byte goes if it lies in a ``length``-byte string of its document that also
starts in a document with a smaller ``doc_id``. Strings are judged on the
input; matches never cross documents.

How it runs
-----------
* Documents are cut by ``doc_id`` into batches of about ``batch_bytes``.
* Every window of ``length`` bytes is filed under its minimizer: the smallest
  hash among its ``seed``-byte substrings. Equal windows have equal
  minimizers, so each minimizer bucket is an index of its own, and a run of
  consecutive windows with one minimizer travels as one fragment of text.
* First exchange: each batch sends its distinct minimizers; a bucket answers
  with one bit for each, "another batch has it". What is in one batch alone
  never travels again.
* Second exchange: each batch sends its distinct fragments under shared
  minimizers. The bucket feeds the batches, in ``doc_id`` order, to a
  :class:`SuffixFamily`: a new batch gets a suffix array (its suffixes sorted
  by their first ``length`` bytes), is merge-scanned against every level, and
  joins the levels; two levels of like size merge, so n batches leave
  O(log n) levels. The answer is one bit a suffix: "an earlier batch has it".
* The batch joins these bits with what repeats inside itself and cuts.

Whole copies of a document with a smaller id need no search: they go by
digest before the first exchange. Whatever is repeated inside a batch is sent
once, so a passage of a third of all rows is one entry a batch, not a row a
document.

Edge cases: null text is empty; a row without ``doc_id`` has no order, is
kept whole and takes nothing from others; rows with one ``doc_id`` don't take
from each other; a text shorter than ``length`` stays; an empty table gives
an empty result; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import M64, _BYTE, mix, powers, text_buffer

_INVERSE = np.uint64(pow(int(M64), -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_STEP = 1 << 17
#: Levels within this ratio of each other in size merge.
RATIO = 4
CELLS = 1 << 16


def _heads(keys: np.ndarray) -> np.ndarray:
    """The first eight bytes of fixed-width byte keys, as ordered integers."""
    head = keys.view(np.uint8).reshape(len(keys), -1)[:, :8]
    head = np.pad(head, ((0, 0), (0, 8 - head.shape[1])))
    return np.ascontiguousarray(head).view(">u8").ravel().astype(np.uint64)


def _suffix_array(keys: np.ndarray) -> np.ndarray:
    """Order of fixed-width byte keys: by eight bytes, then ties by the whole key."""
    head = _heads(keys)
    order = np.argsort(head, kind="stable")
    head = head[order]
    tie = np.zeros(len(keys), bool)
    tie[1:] = head[1:] == head[:-1]
    tie[:-1] |= tie[1:]
    if tie.any():
        part = order[tie]
        order[tie] = part[np.argsort(keys[part], kind="stable")]
    return order


class SuffixFamily:
    """Levels of sorted, distinct ``length``-byte suffix prefixes, with their heads."""

    def __init__(self, length: int):
        self.length = length
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, suffixes: np.ndarray) -> np.ndarray:
        """For a sorted suffix array: which entries some level holds.

        Most entries are settled by their first eight bytes; only where
        several of a level's entries share those is the whole key searched.
        """
        hit = np.zeros(len(suffixes), bool)
        heads = _heads(suffixes)
        for level, level_heads in self.levels:
            low = np.searchsorted(level_heads, heads)
            some = np.flatnonzero(~hit & (level_heads[np.minimum(low, len(level) - 1)] == heads))
            low = low[some]
            hit[some] = level[low] == suffixes[some]
            many = ~hit[some] & (level_heads[np.minimum(low + 1, len(level) - 1)] == heads[some])
            some = some[many]
            at = np.minimum(np.searchsorted(level, suffixes[some]), len(level) - 1)
            hit[some] = level[at] == suffixes[some]
        return hit

    def add(self, suffixes: np.ndarray) -> None:
        """File a sorted array of new suffixes; merge levels of like size."""
        if not len(suffixes):
            return
        self.levels.append((suffixes, _heads(suffixes)))
        while len(self.levels) > 1 and len(self.levels[-1][0]) * RATIO > len(self.levels[-2][0]):
            small, large = sorted((self.levels.pop(), self.levels.pop()), key=lambda x: len(x[0]))
            at = np.searchsorted(large[0], small[0])
            self.levels.append(tuple(np.insert(x, at, y) for x, y in zip(large, small)))

    def batch(self, buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Index one batch; True for each start whose suffix is in an earlier one."""
        if not len(starts):
            return np.zeros(0, bool)
        view = np.lib.stride_tricks.sliding_window_view(buf, self.length)
        keys = np.ascontiguousarray(view[starts]).view(f"S{self.length}").ravel()
        array = _suffix_array(keys)
        keys = keys[array]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        keys = keys[first]
        hit = self.scan(keys)
        self.add(keys[~hit])
        out = np.zeros(len(starts), bool)
        out[array] = hit[np.cumsum(first) - 1]
        return out


def _minimizers(part: np.ndarray, length: int, seed: int) -> np.ndarray:
    """The smallest seed hash of every ``length``-byte window of a piece."""
    power, have, size = M64, _BYTE[part], 1
    whole, done, left = None, 0, seed
    while True:                                               # binary digits of ``seed``
        if left & 1:
            if whole is None:
                whole, done = have, size
            else:
                n = len(have) - done
                whole = have[:n] * powers(done + 1)[done] + whole[size:][:n]
                done += size
        left >>= 1
        if not left:
            break
        have = have[:-size] * power + have[size:]
        power = powers(2 * size + 1)[2 * size]
        size *= 2
    h = whole[:len(part) - seed + 1] * _SPREAD
    h ^= h >> np.uint64(29)
    span, width = length - seed + 1, 1
    while width * 2 <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    n = len(part) - length + 1
    return np.minimum(h[:n], h[span - width:][:n]) if width < span else h


def _changes(raw: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First window and minimizer of each run of windows with one minimizer."""
    starts, values, last = [], [], None
    for at in range(0, len(raw) - length + 1, _STEP):
        m = _minimizers(raw[at:at + _STEP + length - 1], length, seed)
        new = np.empty(len(m), bool)
        new[0] = last is None or m[0] != last
        np.not_equal(m[1:], m[:-1], out=new[1:])
        new = np.flatnonzero(new)
        starts.append(new + at)
        values.append(m[new])
        last = m[-1]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(values)


_DIGIT = 1 << 16


def _scaled(x: np.ndarray, at: np.ndarray, base: np.uint64) -> np.ndarray:
    """x * base ** at, by two digits of the exponent."""
    low = np.full(_DIGIT, base, np.uint64)
    low[0] = 1
    low = np.multiply.accumulate(low)
    high = np.full(int(at.max(initial=0)) // _DIGIT + 1, (low[-1:] * base)[0], np.uint64)
    high[0] = 1
    high = np.multiply.accumulate(high)
    return x * low[at % _DIGIT] * high[at // _DIGIT]


class Batch:
    """The texts of one batch and the minimizer runs of their windows."""

    def __init__(self, docs: pa.Table, copies: dict[bytes, int], length: int, seed: int):
        self.length = length
        self.ids = docs["doc_id"].fill_null(0).to_numpy()
        self.known = docs["doc_id"].is_valid().to_numpy()
        self.raw, self.offsets = text_buffer(docs["text"])
        self.sizes = np.diff(self.offsets)
        # a copy of a smaller id is one whole match if it is long enough
        self.copied = self.known & (self.sizes >= length) & bool(copies)
        for i in np.flatnonzero(self.copied):
            least = copies.get(hashlib.sha256(self.raw[self.offsets[i]:self.offsets[i + 1]]).digest())
            self.copied[i] = least is not None and self.ids[i] > least
        use = np.flatnonzero(self.known & ~self.copied & (self.sizes >= length))
        first, stop = self.offsets[use], self.offsets[use + 1] - length + 1
        starts, values = _changes(self.raw, length, seed)
        if not len(use) or not len(starts):
            self.start = self.count = self.doc = np.zeros(0, np.int64)
            self.which, self.distinct = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        # a document's first window opens a run of its own
        inside = values[np.searchsorted(starts, first, side="right") - 1]
        starts, values = np.concatenate([first, starts]), np.concatenate([inside, values])
        starts, one = np.unique(starts, return_index=True)
        values = values[one]
        owner = np.searchsorted(first, starts, side="right") - 1
        ends = np.append(starts[1:], len(self.raw))
        mine = (owner >= 0) & (starts < stop[owner])
        self.start = starts[mine]
        self.doc = use[owner[mine]]
        self.count = np.minimum(ends[mine], stop[owner[mine]]) - self.start
        self.distinct, self.which = np.unique(values[mine], return_inverse=True)

    def in_two_documents(self) -> np.ndarray:
        """Which distinct minimizers occur under two ids of this batch."""
        ids = self.ids[self.doc]                              # documents ascend by id
        low = np.full(len(self.distinct), np.iinfo(np.int64).max)
        high = np.full(len(self.distinct), np.iinfo(np.int64).min)
        low[self.which[::-1]] = ids[::-1]
        high[self.which] = ids
        return low != high

    def sums(self) -> np.ndarray:
        """Prefix sums for O(1) substring hashes."""
        s = np.zeros(len(self.raw) + 1, np.uint64)
        scale, have = np.uint64(1), np.uint64(0)
        table = powers(_STEP + 1)
        for at in range(0, len(self.raw), _STEP):
            part = self.raw[at:at + _STEP]
            piece = s[at + 1:at + 1 + len(part)]
            np.cumsum(_BYTE[part] * table[:len(part)], out=piece)
            piece *= scale
            piece += have
            have = piece[-1]
            scale = (table[_STEP:] * scale)[0]
        return s

    def fragments(self, shared: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fragments under shared minimizers, ordered by content hash.

        (the runs they come from, the fragment of each, one run a fragment)
        """
        runs = np.flatnonzero(shared[self.which])
        a = self.start[runs]
        size = self.count[runs] + self.length - 1
        h = mix(_scaled(s[a + size] - s[a], a, _INVERSE) + size.astype(np.uint64) * M64)
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        return runs, which, runs[one]

    def repeated(self, s: np.ndarray) -> np.ndarray:
        """Windows that a smaller id of this batch has too."""
        local = np.flatnonzero(self.in_two_documents()[self.which])
        windows = _gather(self.start[local], self.count[local])
        h = _scaled(s[windows + self.length] - s[windows], windows, _INVERSE)
        order = np.argsort(h, kind="stable")                  # documents ascend: first is smallest
        h = h[order]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        ids = np.repeat(self.ids[self.doc[local]], self.count[local])[order]
        return windows[order[ids > ids[first][np.cumsum(first) - 1]]]


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(values) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start+1, ... of the given counts."""
    at = np.cumsum(counts) - counts
    return np.repeat(starts - at, counts) + np.arange(int(counts.sum()))


_NOTE = "batch long, kind string, bucket long, doc_id long, data binary"
_SEND = "bucket long, batch long, data binary, lengths binary"


def _pack(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x)


def _unpack(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x) if x else b""


def _notes(notes: pa.Table):
    copies, bits = {}, {"shared": {}, "earlier": {}}
    for kind, bucket, doc, data in zip(*(notes[c].to_pylist() for c in ("kind", "bucket", "doc_id", "data"))):
        if kind == "copy":
            copies[data] = doc
        else:
            bits[kind][bucket] = np.unpackbits(np.frombuffer(_unpack(data), np.uint8)).view(bool)
    return copies, bits


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [x.split() for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.table([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(fields)],
                    names=[n for n, _ in fields])


def _meet(bucket: int, table: pa.Table) -> list[tuple]:
    """For each batch in a bucket, bits of the minimizers that another batch has."""
    sent = [(x, np.frombuffer(d, np.uint64)) for x, d in zip(table["batch"].to_pylist(), table["data"].to_pylist())]
    values = np.sort(np.concatenate([d for _, d in sent]))
    twice = np.unique(values[1:][values[1:] == values[:-1]])
    out = []
    for x, d in sent:
        hit = np.zeros(len(d), bool)
        if len(twice):
            at = np.minimum(np.searchsorted(twice, d), len(twice) - 1)
            hit = twice[at] == d
        if hit.any():
            out.append((x, "shared", bucket, None, _pack(np.packbits(hit).tobytes())))
    return out


def _by_bucket(bucket: np.ndarray, buckets: int):
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _answer(bucket: np.ndarray, bits: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """Bits of the buckets, put back in the order of ``bucket``'s entries."""
    out = np.zeros(len(bucket), bool)
    order, cut = _by_bucket(bucket, buckets)
    for b, got in bits.items():
        mine = order[cut[b]:cut[b + 1]]
        out[mine] = got[:len(mine)]
    return out


def _fragment_bits(batch: Batch, one: np.ndarray, bits: dict[int, np.ndarray], buckets: int) -> np.ndarray:
    """Bits of the windows of each fragment, fragments in their order."""
    bucket = bucket_of(batch.distinct[batch.which[one]], buckets)
    order, cut = _by_bucket(bucket, buckets)
    counts = batch.count[one]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), bool)
    for b, got in bits.items():
        mine = order[cut[b]:cut[b + 1]]
        if len(mine):
            where = _gather(at[mine], counts[mine])
            out[where] = got[:len(where)]
    return out


def dedup(
    docs: DataFrame, length: int = 50, seed: int = 20, batch_bytes: int = 8 << 20, most_buckets: int = 1 << 16,
    with_text: bool = True,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` holds the bytes that stay (null without ``with_text``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    low, high, total = rows.agg(F.min("doc_id"), F.max("doc_id"), F.sum(F.octet_length("text"))).first()
    low, high, total = low or 0, high or 0, total or 0
    # batches of like size: equal doc_id cells, gathered until they fill one
    batch_bytes = max(batch_bytes, total >> 19)
    cells = min(CELLS, high - low + 1)
    wide = [F.lit(str(n)).cast("decimal(38,0)") for n in (low, cells, high - low + 1)]   # ids may span all 64 bits
    cell = F.floor((F.col("doc_id").cast("decimal(38,0)") - wide[0]) * wide[1] / wide[2]).cast("long")
    n_batches = max(1, math.ceil(total / batch_bytes))
    sizes = rows.groupBy(cell.alias("cell")).agg(F.sum(F.octet_length("text")).alias("bytes")).where("cell is not null")
    sums = sorted((r.cell, r.bytes) for r in sizes.collect())       # CELLS rows at most
    ends, have = [], 0
    for c, b in sums:
        have += b
        if have >= batch_bytes:
            ends.append(c)
            have = 0
    buckets = min(most_buckets, 2 * n_batches)
    parts = len(ends) + 1
    spark = docs.sparkSession
    table, b = [], 0
    for c, _ in sums:
        table.append((c, b))
        if b < len(ends) and c == ends[b]:
            b += 1
    of_cell = F.broadcast(spark.createDataFrame(table, "cell long, batch long"))
    rows = rows.withColumn("cell", cell).join(of_cell, "cell", "left").select(
        F.coalesce("batch", F.pmod(F.xxhash64("text"), F.lit(parts))).cast("long").alias("batch"), "doc_id", "text")
    held = rows.repartition(parts, "batch")

    # whole copies: a row for each text and batch, however many copies a batch holds
    texts = rows.where("doc_id is not null").groupBy("batch", F.sha2("text", 256).alias("digest")).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    least = texts.groupBy(F.col("digest").alias("of")).agg(F.min("first").alias("least"), F.max("last").alias("most")).where("most > least")
    copies = texts.join(least, F.col("digest") == F.col("of")).where("last > least").select(
        F.col("batch").alias("batch"), F.lit("copy").alias("kind"), F.lit(0).cast("long").alias("bucket"),
        F.col("least").alias("doc_id"), F.unhex("digest").alias("data"))

    def opened(docs_, notes_):
        copies_, bits = _notes(notes_)
        return Batch(docs_.sort_by("doc_id"), copies_, length, seed), bits

    def send_minimizers(key, docs_, notes_):
        batch, _ = opened(docs_, notes_)
        order, cut = _by_bucket(bucket_of(batch.distinct, buckets), buckets)
        return _table([(b, key[0].as_py(), batch.distinct[order[cut[b]:cut[b + 1]]].tobytes(), None)
                       for b in np.flatnonzero(np.diff(cut)).tolist()], _SEND)

    def meet_minimizers(key, table_):
        return _table(_meet(key[0].as_py(), table_), _NOTE)

    def send_fragments(key, docs_, notes_):
        batch, bits = opened(docs_, notes_)
        shared = _answer(bucket_of(batch.distinct, buckets), bits["shared"], buckets)
        _, _, one = batch.fragments(shared, batch.sums())
        order, cut = _by_bucket(bucket_of(batch.distinct[batch.which[one]], buckets), buckets)
        out = []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            mine = one[order[cut[b]:cut[b + 1]]]
            counts = batch.count[mine]
            text = batch.raw[_gather(batch.start[mine], counts + length - 1)]
            out.append((b, key[0].as_py(), _pack(text.tobytes()), _pack(counts.astype(np.uint32).tobytes())))
        return _table(out, _SEND)

    def search(key, table_):
        family, out = SuffixFamily(length), []
        table_ = table_.sort_by("batch")
        for x, data, lengths in zip(*(table_[c] for c in ("batch", "data", "lengths"))):
            buf = np.frombuffer(_unpack(data.as_py()), np.uint8)
            counts = np.frombuffer(_unpack(lengths.as_py()), np.uint32).astype(np.int64)
            size = counts + length - 1
            hit = family.batch(buf, _gather(np.cumsum(size) - size, counts))
            if hit.any():
                out.append((x.as_py(), "earlier", key[0].as_py(), None, _pack(np.packbits(hit).tobytes())))
        return _table(out, _NOTE)

    def cut_out(key, docs_, notes_):
        batch, bits = opened(docs_, notes_)
        s = batch.sums()
        found = np.zeros(len(batch.raw) + length, bool)       # windows to remove, by their first byte + length
        if bits["earlier"]:
            shared = _answer(bucket_of(batch.distinct, buckets), bits["shared"], buckets)
            runs, which, one = batch.fragments(shared, s)
            hits = _fragment_bits(batch, one, bits["earlier"], buckets)
            counts = batch.count[one]
            at = (np.cumsum(counts) - counts)[which]
            found[length + _gather(batch.start[runs], batch.count[runs])[hits[_gather(at, batch.count[runs])]]] = True
        found[length + batch.repeated(s)] = True
        del s
        have = np.cumsum(found, dtype=np.int32)
        gone = have[length:] > have[:-length]
        out = []
        for i in range(len(batch.sizes)):
            a, z = int(batch.offsets[i]), int(batch.offsets[i + 1])
            g = gone[a:z]
            if batch.copied[i]:
                kept, removed, spans = b"", z - a, 1
            elif g.any():
                removed = int(g.sum())
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
                kept = batch.raw[a:z][~g].tobytes()
            else:
                kept, removed, spans = batch.raw[a:z].tobytes(), 0, 0
            out.append((int(batch.ids[i]) if batch.known[i] else None, z - a, removed, spans,
                        hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        return _table(out, _OUT)

    def notes(*frames: DataFrame) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out.repartition(parts, "batch").groupBy("batch")

    # buckets keep their size as the corpus grows; so do tasks, if a partition each isn't coalesced
    by_batch = held.groupBy("batch")
    sent = by_batch.cogroup(notes(copies)).applyInArrow(send_minimizers, _SEND)
    shared = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet_minimizers, _NOTE)
    fragments = by_batch.cogroup(notes(copies, shared)).applyInArrow(send_fragments, _SEND)
    earlier = fragments.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(search, _NOTE)
    return by_batch.cogroup(notes(copies, shared, earlier)).applyInArrow(cut_out, _OUT)


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
