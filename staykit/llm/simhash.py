"""SimHash near-duplicates with pigeonring filtering.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, ``shingle``-word
shingles with repeats (all words if fewer; none: fingerprint zero), XXH64 of
each (UTF-8, seed 42); a bit is 1 if it is 1 in over half the hashes.

Pigeonring: cut the 64 bits into ``most + 1`` ring segments. If two
fingerprints differ in at most ``most`` bits, then from some segment on every
chain of j consecutive segments differs in at most j * most / (most + 1)
bits. So the first segment of the chain agrees, and the second differs in at
most one bit, hence one of its halves agrees: first segment and half of the
second are the bucket key. Inside a bucket the longer chains are held to
their budgets, and only what passes gets the full Hamming check.

Only distinct fingerprints are compared, and a bucket returns a spanning
forest of its links, not all of them: linked sets are the same and a group of
near copies costs one edge a member. Buckets stream from a sorted partition;
none is gathered in a group. Components come from star contraction.

Edge cases: null text is empty (fingerprint zero, linked like any other);
a null ``doc_id`` gets a fingerprint and joins its component but never names
it (a component of nulls only has a null name); repeated rows are returned
as often as they come; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .components import components
from .kernel import LOWER, slices, text_buffer

SEED = 42


def _fingerprint(text: bytes, n: int) -> int:
    """``text`` is lower-cased already."""
    words = text.split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return digest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = [digest(line[a:z], SEED) for a, z in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())]
    total = len(hashes)
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, np.uint64)
    for at in range(0, total, 1 << 16):                     # bounded for a very long text
        part = values[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, mark, fp) of every row; ``mark`` is a 64-bit hash of id and text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw, off = text_buffer(part.column("text"))
            low = LOWER[raw].tobytes()
            out = [_fingerprint(low[a:z], shingle) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("mark"), pa.array(np.array(out, np.uint64).view(np.int64))],
                names=["doc_id", "mark", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _mark(docs).alias("mark"))
    return rows.mapInArrow(scan, "doc_id long, mark long, fp long")


def _mark(docs: DataFrame) -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def segments(most: int) -> list[tuple[int, int]]:
    """(shift, width) of the most + 1 ring segments of 64 bits."""
    n = most + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(n)]


def _bits(column, shift: int, width: int):
    return F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(most: int):
    """Bucket keys of one fingerprint: for every start, first segment and one half of the second."""
    parts, out = segments(most), []
    for i, (shift, width) in enumerate(parts):
        to, wide = parts[(i + 1) % len(parts)]
        half = wide // 2
        for h, (s, w) in enumerate(((to, half), (to + half, wide - half))):
            key = F.shiftleft(_bits(F.col("fp"), shift, width), 32).bitwiseOR(F.shiftleft(_bits(F.col("fp"), s, w), 8))
            out.append(key.bitwiseOR(F.lit(2 * i + h)))
    return out


def _links(key: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Spanning-forest links of one chunk of whole buckets (sorted by key)."""
    parts = segments(most)
    n = len(parts)
    masks = np.array([((1 << w) - 1) << s for s, w in parts], np.uint64)
    where = ((key & 0xFF) // 2).astype(np.int64)
    root = np.arange(len(fp))

    def find(x):
        while (root[x] != root[root[x]]).any():
            root[:] = root[root]
        return root[x]

    edges, step = [], 1
    live = np.arange(len(fp) - 1)
    while len(live):
        live = live[live + step < len(fp)]
        live = live[key[live] == key[live + step]]
        if not len(live):
            break
        a, b = live, live + step
        open_ = find(a) != find(b)
        a, b = a[open_], b[open_]
        diff, at = fp[a] ^ fp[b], where[a]
        used = np.zeros(len(a), np.int64)
        for j in range(1, n):                              # chains of 1 .. n-1 segments
            used = used + np.bitwise_count(diff & masks[(at + j - 1) % n])
            keep = used * n <= j * most
            a, b, diff, at, used = a[keep], b[keep], diff[keep], at[keep], used[keep]
        close = np.bitwise_count(diff) <= most             # the full check
        a, b = a[close], b[close]
        for x, y in zip(a.tolist(), b.tolist()):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((x, y))
        step += 1
    return np.array(edges, np.int64).reshape(-1, 2)


def links(distinct: DataFrame, most: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints at ``most`` or fewer bits.

    Every linked set comes out connected; links inside it may be left out.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(key, fp):
            e = fp[_links(key, fp.view(np.uint64), most)] if len(key) > 1 else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])

        held, fps = [], []
        for batch in batches:
            k, f = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if not len(k):
                continue
            held.append(k)
            fps.append(f)
            if k[0] == k[-1] and held[0][0] == k[0]:
                continue                                    # one bucket, not over yet
            key, fp = np.concatenate(held), np.concatenate(fps)
            cut = int(np.searchsorted(key, key[-1]))
            yield chunk(key[:cut], fp[:cut])
            held, fps = [key[cut:]], [fp[cut:]]
        if held:
            yield chunk(np.concatenate(held), np.concatenate(fps))

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("fp", F.explode(F.array(*_keys(most))).alias("key"))
    return keyed.repartition(parts, "key").sortWithinPartitions("key").select("key", "fp").mapInArrow(scan, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """Per row: doc_id, mark, fp (long), fingerprint (16 hex digits), component_id, root.

    ``component_id`` is the smallest doc_id reachable over links of ``most``
    or fewer differing bits.
    """
    checkpoint_root(docs.sparkSession)
    fps = fingerprints(docs, shingle).checkpoint()
    owners = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(owners.select("fp"), most))
    named = owners.join(roots, owners.fp == roots.node, "left").select(
        owners.fp, F.coalesce("root", owners.fp).alias("root"), "least")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(names, "root").select(F.col("fp").alias("of"), "component_id", "root")
    return fps.join(of, F.col("fp") == F.col("of")).select(
        "doc_id", "mark", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """The input rows, one of each component: the smallest doc_id's.

    Rows with equal id and text count as one; a null id stays only where its
    component has no other.
    """
    groups = near_duplicates(docs, shingle, most)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("mark"))).alias("first")
    keep = groups.groupBy("root").agg(first).select(F.col("first.mark").alias("of"))
    rows = docs.select(_mark(docs).alias("mark"), F.struct(*docs.columns).alias("row"))
    # one shuffle: the join and the removal of repeated rows share the key
    return rows.join(keep, F.col("mark") == F.col("of"), "left_semi").dropDuplicates(["mark"]).select("row.*")
