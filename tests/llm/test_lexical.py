"""Ranked lexical search against plain Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from staykit.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            if not c:
                continue
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def found(spark, docs_of, docs, items, k, **kwargs):
    return sorted(map(tuple, lexical.search(docs_of(docs), spark.createDataFrame(items, ITEMS), k, **kwargs).collect()), key=str)


def text(rnd, n):
    return "".join(rnd.choice(["été ", "Wort ", "a ", "B2 ", "the-", "x_y ", "中文 ", " ", f"w{rnd.randint(0, 40)} "]) for _ in range(n))


@pytest.mark.parametrize("tile", [(256, 1024), (3, 5)])
def test_equals_plain_integers(spark, docs_of, monkeypatch, tile):
    monkeypatch.setattr(lexical, "ITEM_TILE", tile[0])
    monkeypatch.setattr(lexical, "DOC_TILE", tile[1])
    rnd = random.Random(3)
    docs = [(i, text(rnd, rnd.choice([0, 1, 5, 80]))) for i in range(150)]
    items = [(i, text(rnd, rnd.choice([0, 2, 9]))) for i in range(25)]
    assert found(spark, docs_of, docs, items, 7, block_items=10) == plain(docs, items, 7)


def test_ties_copies_nulls_and_blanks(spark, docs_of):
    docs = [(i, "Same text") for i in range(40, 0, -1)] + [(50, None), (51, ""), (52, " -- "), (None, "same"), (None, "same text"), (7, "other words")]
    items = [(1, "same"), (1, "SAME"), (2, None), (3, "..."), (None, "other"), (4, "missing")]
    assert found(spark, docs_of, docs, items, 5) == plain(docs, items, 5)


def test_empty_tables(spark, docs_of):
    assert found(spark, docs_of, [], [(1, "a")], 5) == []
    assert found(spark, docs_of, [(1, None)], [(1, "a")], 5) == []
    assert found(spark, docs_of, [(1, "a b")], [], 5) == []


def test_very_long_texts(spark, docs_of):
    docs = [(1, "alpha beta " * 300_000), (2, "alpha"), (3, "gamma " * 10)]
    items = [(1, "alpha " * 5_000 + "beta"), (2, "gamma")]
    assert found(spark, docs_of, docs, items, 5) == plain(docs, items, 5)


def test_sums_stay_below_two_to_the_53():
    weights = np.array([20_000, 25_000, 1, 0], np.int64)
    rows = [[0] * 400_000 + [1] * 900_000 + [2], [3, 2, 2]]
    tile = lexical.tile(0, rows, weights)
    total = np.zeros((2, 4), np.int64)
    for vocabulary, matrix in tile.parts:
        assert (matrix.sum(axis=1) * lexical.MOST_IMPACT < lexical.EXACT).all()
        total[:, vocabulary] += matrix.astype(np.int64)
    assert total.tolist() == [[400_000 * 20_000, 900_000 * 25_000, 1, 0], [0, 0, 2, 0]]


def test_best_keeps_every_tie_until_the_ids_decide():
    score = np.array([[5, 9, 5, 5, 0, 5]])
    row, column = lexical.best(score, np.array([60, 50, 40, 30, 20, 10]), 3)
    assert column.tolist() == [1, 5, 3] and row.tolist() == [0, 0, 0]
