import random
import re

import pytest

from staykit.llm.decontam import clean, pairs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(t)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(docs, items):
    out = []
    for d, t in docs:
        held = shingles(t)
        for i, q in items:
            own = shingles(q)
            both = len(own & held)
            if own and 5 * both >= 4 * len(own):
                out.append((d, i, len(own), both))
    return sorted(out, key=str)


def made(seed):
    r = random.Random(seed)
    words = [a + b for a in ("th", "Är", "on", "re") for b in ("e", "ing", "é", "st", "of")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, text(r.randrange(1, 45))) for i in range(40)] + [(90, None), (91, "  "), (92, "one two"), (92, "one two"), (None, text(12))]
    docs = [(1, None), (2, ""), (3, "One\ttwo"), (4, "one two three"), (None, items[3][1])]
    for i in range(120):
        t = text(r.randrange(0, 200)).split()
        if i % 2:
            q = (r.choice(items)[1] or "").split() or ["x"]
            for _ in range(r.randrange(3)):
                q[r.randrange(len(q))] = "other"
            at = r.randrange(len(t) + 1)
            t[at:at] = [x.upper() if i % 4 == 1 else x for x in q]
        docs.append((10 + i // 2, " \n".join(t) if i % 3 else " ".join(t)))
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 7)])
def test_pairs_and_clean_against_brute_force(docs_of, spark, seed, block):
    docs, items = made(seed)
    table = docs_of(docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    got = [tuple(g)[:4] for g in pairs(table, bench, block_items=block).collect()]
    assert sorted(got, key=str) == want and len(want) > 8
    hit = {t for _, t in docs if any(5 * len(shingles(q) & shingles(t)) >= 4 * len(shingles(q)) for _, q in items if shingles(q))}
    kept = clean(table, bench, block_items=block)
    assert kept.columns == table.columns
    assert sorted((g.text for g in kept.collect()), key=str) == sorted((t for _, t in docs if t not in hit), key=str)


def test_empty_tables(docs_of, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert pairs(docs_of([(1, "a b c")]), none).collect() == []
    assert pairs(docs_of([]), spark.createDataFrame([(1, "a b c")], none.schema)).collect() == []
    assert clean(docs_of([(1, "a b c")]), none).count() == 1
