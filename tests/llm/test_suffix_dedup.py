import hashlib
import random

import numpy as np
import pytest

from staykit.llm.suffix_dedup import SuffixFamily, dedup


def brute(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - length + 1):
                w = b[p:p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60):
    r = random.Random(seed)
    words = ["the", "ärger", "of", "thon", "aaaa", "zebra", "x", "\n", "été", "über", "42"]
    passage = " ".join(r.choice(words) for _ in range(60))
    rows = []
    for i in range(n):
        t = " ".join(r.choice(words) + str(r.randrange(9)) for _ in range(r.randrange(0, 60)))
        k = r.randrange(6)
        if k == 0 and rows:
            t = r.choice(rows)[1]
        elif k == 1 and rows:
            o = r.choice(rows)[1] or ""
            cut = r.randrange(len(o) + 1)
            t = o[:cut] + "#" + o[cut:] + t
        elif k == 2:
            t = t + passage[r.randrange(30):r.randrange(100, len(passage))] + t[:40]
        elif k == 3:
            t = t + "ab" * r.randrange(80)
        rows.append((i * 7, t))
    rows += [(None, passage), (None, None), (3, ""), (7, rows[1][1]), (7, passage + passage), (9999, passage), (5, "\x00" * 90), (6, "\x00" * 70)]
    return rows


@pytest.mark.parametrize("seed,batch", [(1, 1 << 20), (2, 1500), (3, 300)])
def test_against_brute_force(docs_of, seed, batch):
    rows = made(seed)
    got = [tuple(r)[:5] for r in dedup(docs_of(rows), batch_bytes=batch).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_ids_of_all_64_bits(docs_of):
    text = "a passage that is long enough to be cut where it comes again, you see"
    rows = [(-2**63, text), (-5, "x" + text), (0, "short"), (2**63 - 1, text + "y"), (2**62, "alone " * 20)]
    for batch in (40, 1 << 20):
        assert sorted((tuple(r)[:5] for r in dedup(docs_of(rows), batch_bytes=batch).collect()), key=str) == brute(rows)


def test_empty_table(docs_of, spark):
    assert dedup(docs_of([])).collect() == []


def test_family_levels_grow_logarithmically():
    r = np.random.default_rng(0)
    family, seen = SuffixFamily(8), set()
    for _ in range(64):
        buf = r.integers(97, 100, 200).astype(np.uint8)
        starts = np.arange(len(buf) - 7)
        hit = family.batch(buf, starts)
        keys = [buf[s:s + 8].tobytes() for s in starts]
        assert hit.tolist() == [k in seen for k in keys]
        seen.update(keys)
    assert len(family.levels) <= 12 and sum(len(level) for level, _ in family.levels) == len(seen)
