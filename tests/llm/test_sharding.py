import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from staykit.llm.sharding import best_fit_decreasing, pack, shard


def naive(sizes, capacity, shards):
    """Best-fit decreasing by linear search, one group at a time."""
    left, out = [], []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if fits:
            i = min(fits)[1]
        elif len(left) < shards and s <= capacity:
            left.append(capacity)
            i = len(left) - 1
        else:
            return None
        left[i] -= s
        out.append((s, i))
    return sorted(left)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(16, 60), min_size=1, max_size=80), st.integers(60, 400), st.integers(1, 9))
def test_tree_packs_as_linear_search(sizes, capacity, shards):
    counts = defaultdict(int)
    for s in sizes:
        counts[s] += 1
    got = best_fit_decreasing(sorted(counts.items(), reverse=True), capacity, shards)
    want = naive(sizes, capacity, shards)
    assert (got is None) == (want is None)
    if got is not None:
        used = defaultdict(int)
        for s, n, b in got:
            used[b] += s * n
        assert sorted(capacity - u for u in used.values()) == want


def test_rows_groups_slots_and_balance(docs_of):
    r = random.Random(2)
    texts = ["x" * r.randrange(0, 400) + str(i) for i in range(1500)]
    texts += [r.choice(texts) for _ in range(200)] + ["hot copy"] * 150 + [None, "", "", None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "é" * 30), (3, texts[3]), (3, texts[3])]
    got = shard(docs_of(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((str(g.doc_id), g["size"], g.text_crc32) for g in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    by, size, where = defaultdict(list), defaultdict(int), defaultdict(set)
    text = {i: t or "" for i, t in rows}
    for g in got:
        assert g.law == "bytes" and g.grown_shard is None
        by[g.shard].append(g.slot)
        size[g.shard] += g["size"]
        where[text[g.doc_id]].add(g.shard)
    assert set(by) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(len(s) == 1 for s in where.values())
    assert max(size.values()) - min(size.values()) < 0.05 * max(size.values())


def test_a_group_above_the_share_stands_alone():
    runs = pack([(1000, 1), (10, 300)], 5)
    used = defaultdict(int)
    for s, n, b in runs:
        used[b] += s * n
    assert sorted(used.values()) == [750, 750, 750, 750, 1000]


def test_empty_table(docs_of):
    assert shard(docs_of([])).collect() == []
