"""Periodic runs against a word-by-word search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staykit.llm import periodic
from staykit.llm.queries import spun, spun_texts


def brute(words):
    """All runs by comparing each word with the one a period later."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q):
                    out.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def made(rnd):
    out = []
    for _ in range(rnd.randint(0, 6)):
        if rnd.random() < 0.6:
            root = [rnd.randint(0, rnd.choice([1, 2, 30])) for _ in range(rnd.randint(1, 7))]
            out += (root * rnd.randint(1, 9))[:rnd.randint(1, 60)]
        else:
            out += [rnd.randint(0, rnd.choice([1, 3, 50])) for _ in range(rnd.randint(0, 30))]
    return out


def test_runs_equal_brute_force():
    rnd = random.Random(5)
    for _ in range(400):
        docs = [made(rnd) for _ in range(rnd.randint(0, 7))]
        assert periodic.runs_of([np.array(d, np.int64) for d in docs]) == [brute(d) for d in docs]


def grammar_of(words):
    _, ids = np.unique(np.array([-1, *words, max(words, default=0) + 1]), return_inverse=True)
    return ids, periodic.Grammar(ids.astype(np.int64), np.array([0, len(ids) - 1]))


def test_extensions_equal_word_by_word():
    rnd = random.Random(6)
    for _ in range(25):
        ids, g = grammar_of(made(rnd) or [1])
        n = len(ids)
        x, y = np.array([(a, b) for a in range(1, n - 1) for b in range(a + 1, n - 1)] or [(0, 1)]).T
        for step in (1, -1):
            want = []
            for a, b in zip(x, y):
                k = 0
                while ids[a + step * k] == ids[b + step * k]:
                    k += 1
                want.append(k)
            assert g.extension(x, y, step).tolist() == want


def test_grammar_spells_the_words():
    rnd = random.Random(7)
    for _ in range(30):
        ids, g = grammar_of(made(rnd))
        rules = {}
        for (low, left, right), block in zip(g.rules, g.block):
            for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
                rules[low + i] = [a] * b if block else [a, b]

        def spell(s):
            return sum(map(spell, rules[s]), []) if s in rules else [s]

        assert len(g.symbols[-1]) == 2
        assert sum(map(spell, g.symbols[-1].tolist()), []) == ids.tolist()


def test_long_texts():
    (run,), many, none = periodic.runs_of([np.tile(np.arange(911), 60), np.zeros(200_000, np.int64), np.arange(100_000)])
    assert run == (0, 911 * 60, 911) and many == [(0, 200_000, 1)] and none == []


ROWS = [(1, "a a a a a a b"), (2, None), (3, ""), (4, " \t\n"), (5, "x y x y x y x y"), (5, "x y x y x y x y"), (None, "a a a a a a b"),
        (6, "a a a a a"), (7, "p q r " * 5 + "z z z z z z z"), (8, "é  é  é  é  é  é ")]


def test_rows_and_edge_cases(spark, docs_of):
    got = {(r.doc_id, r.n_words): r for r in periodic.find(docs_of(ROWS)).collect()}
    assert [tuple(x) for x in got[1, 7].runs] == [(0, 6, 1)] and got[1, 7].collapsed == "a b"
    assert [tuple(x) for x in got[None, 7].runs] == [(0, 6, 1)]
    assert got[2, 0].runs == [] and got[2, 0].collapsed == "" and got[4, 0].collapsed == ""
    assert [tuple(x) for x in got[5, 8].runs] == [(0, 8, 2)] and got[5, 8].collapsed == "x y"
    assert got[6, 5].runs == []
    assert [tuple(x) for x in got[7, 22].runs] == [(0, 15, 3), (15, 7, 1)] and got[7, 22].collapsed == "p q r z"
    assert got[8, 6].collapsed == "é "
    assert periodic.find(docs_of(ROWS)).count() == len(ROWS)
    assert periodic.digests(periodic.find(docs_of([]))).collect() == []


def plain(doc_id, text):
    """The contract, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(keep)).hexdigest())


def test_query_equals_brute_force(spark, docs_of):
    rnd = random.Random(8)
    rows = [(i, " ".join("abc"[w % 3] * (1 + w % 2) for w in made(rnd)) if i % 3 else " ".join(str(rnd.random()) for _ in range(rnd.randint(0, 90))))
            for i in range(400)]
    got = periodic.digests(periodic.find(spun_texts(docs_of(rows)))).collect()
    want = [plain(i, t) for i, t in rows]
    assert sum(1 for w in want if w[1]) > 100
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("doc_id", [0, 3, None])
def test_spun_leaves_short_input_alone(doc_id):
    assert spun([], doc_id) == []


def test_exact_exponents_and_ties(spark):
    runs = [(0, 9, 2), (20, 14, 3), (40, 9, 2), (60, 28, 6)]             # 4.5, 4.666.., 4.5, 4.666..
    df = spark.createDataFrame([(1, 99, runs, "")], periodic.SCHEMA)
    r = periodic.digests(df).first()
    assert (r.start, r.length, r.period, r.exponent_milli) == (20, 14, 3, 4666)
    assert periodic.digests(df.withColumn("runs", F.slice("runs", 1, 0))).first().start is None
