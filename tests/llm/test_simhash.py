import random

import numpy as np
import xxhash

from staykit.llm.simhash import _links, keep_one, near_duplicates, segments


def fingerprint(text, n=4):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = t.encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, most=4):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def made(seed):
    r = random.Random(seed)
    words = ["The", "of", "Ärger", "thon", "zebra", "x", "été", "über", "42", "ing", "er"]
    rows = [(1000, None), (5, ""), (6, " \t\n"), (7, "one"), (7, "One"), (None, "one"), (8, "a b c"), (9, "a  b\tc d")]
    for i in range(60):
        t = " ".join(r.choice(words) for _ in range(r.randrange(0, 120)))
        rows.append((10 + i, t))
        for j in range(r.randrange(3)):
            w = t.split()
            if w:
                w[r.randrange(len(w))] = "edit"
            rows.append((200 + 3 * i + j, " ".join(w)))
    return rows


def test_against_brute_force(docs_of):
    rows = made(3)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs_of(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).collect() == []


def test_every_close_pair_shares_a_chain_and_is_connected():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False)) for _ in range(40)], np.uint64)
    near = base ^ flips
    parts = segments(4)
    for x, y in zip(base, near):
        found = False
        for i, (s, w) in enumerate(parts):
            to, wide = parts[(i + 1) % 5]
            half = wide // 2
            for h, (s2, w2) in enumerate(((to, half), (to + half, wide - half))):
                k = [((int(v) >> s) & (1 << w) - 1) << 32 | ((int(v) >> s2) & (1 << w2) - 1) << 8 | 2 * i + h for v in (x, y)]
                if k[0] == k[1]:
                    e = _links(np.array(k), np.array([x, y]), 4)
                    found |= len(e) == 1
        assert found


def test_one_row_of_each_component_stays(docs_of):
    rows = made(3) + [(7, "one"), (None, "lonely words here")]
    docs = docs_of(rows).selectExpr("*", "1 as root", "2 as mark")
    got = keep_one(docs)
    assert got.columns == docs.columns
    got = got.collect()
    want = brute(rows)
    named = {c for _, _, c in want if c is not None}
    assert sorted(g.doc_id for g in got if g.doc_id is not None) == sorted(named)
    assert [g.text for g in got if g.doc_id is None] == ["lonely words here"]
