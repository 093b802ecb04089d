import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from staykit.llm import toxicity as X
from staykit.llm.kernel import Words

BAD = ["scum", "idiot", "trash"]


def made(n=400, seed=5):
    r = random.Random(seed)
    words = [a + b for a in ("the", "an", "er", "ouß", "st", "re") for b in ("tion", "ing", "ble", "ed", "é", "or", "")]
    rows, labels = [], []
    for i in range(n):
        t = [r.choice(words) + r.choice(["", ",", "."]) for _ in range(r.randrange(5, 80))]
        bad = i % 5 == 0
        for _ in range(1 + len(t) // 20 if bad else 0):
            t.insert(r.randrange(len(t)), r.choice(BAD).title())
        rows.append((i, " ".join(t)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_fold(docs_of, spark):
    rows, labels = made()
    docs = docs_of(rows + [(None, None), (5000, ""), (5001, "x" * 200_000)])
    known = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = X.fit(docs, known)
    got = X.score(docs, model).collect()
    assert len(got) == len(rows) + 3 and all(0 <= g.score <= 1 for g in got)
    for g in got:
        assert g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 4 == 2)
        assert g.predicted == int(g.score >= 0.3)
    out = [g for g in got if g.held_out and g.doc_id < 400]
    right = sum(g.predicted == int(g.doc_id % 5 == 0) for g in out)
    assert right >= 0.95 * len(out)
    assert not any(g.predicted for g in got if g.doc_id is None or g.doc_id >= 5000)


def test_labels_of_the_held_out_fold_change_nothing(docs_of, spark):
    rows, labels = made(120)
    docs = docs_of(rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (X.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert np.array_equal(a.ratios, b.ratios) and np.allclose(a.curve.weights, b.curve.weights)


def plain_counts(rows, toxic):
    """Class counts, vocabulary and left neighbours, word by word."""
    tokens = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or "")) for _, t in rows]
    held = [(toxic.get(i), ws) for (i, _), ws in zip(rows, tokens)]
    seen = Counter(w for c, ws in held if c is not None for w in set(ws))
    words = {w for w, n in seen.items() if n > 1}
    count = [Counter(w if w in words else None for c, ws in held if c == k for w in {x if x in words else None for x in ws}) for k in (1, 0)]
    left = {(a if a in words or a == "" else None, w if w in words else None) for _, ws in held for a, w in zip(["", *ws], ws)}
    return words, count, Counter(w for _, w in left)


def test_counts_and_probabilities_match_a_plain_computation_and_sum_to_one(docs_of, spark):
    rows, labels = made(200)
    rows += [(900 + i, f"new{i} scum word{i % 3} the") for i in range(30)] + [(990, None), (991, "")]
    toxic = {i: t for i, _, t in labels if i % 4 != 1}
    docs = docs_of(rows)
    known = spark.createDataFrame([(t, toxic[i]) for i, t in rows if i in toxic], "text string, toxic int")
    c = X.count(docs, known)
    words, count, left = plain_counts(rows, toxic)
    assert len(c.words) == len(words) and (np.diff(c.words.view(np.int64).astype(object)) != 0).all()
    total = sum(left.values()) + 0.5 * (len(words) + 1)
    drop = [0, 1, 1.8, 2.5]
    for w in [None, *sorted(words)]:
        at = np.zeros(1, np.int64) if w is None else X._number(c.words, Words(pa.array([w]), space=X.TOKEN_SPACE).hash)
        assert (w is None) == (at[0] == 0)
        for k, got in ((0, c.toxic), (1, c.ordinary)):
            n, size = count[k][w], sum(count[k].values())
            mass = sum(min(x, drop[min(x, 3)]) for x in count[k].values()) / size
            assert got[at[0]] == n
            want = max(n - drop[min(n, 3)], 0) / size + mass * (left[w] + 0.5) / total
            assert abs(c.probability(at, k == 0)[0] - want) < 1e-12
    for k in (True, False):
        assert abs(c.probability(np.arange(len(c.toxic)), k).sum() - 1) < 1e-9


def test_scores_match_a_plain_computation_from_end_to_end(docs_of, spark):
    rows, labels = made(160)
    docs = docs_of(rows)
    model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    train = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    words, count, left = plain_counts(rows, train)
    total, drop = sum(left.values()) + 0.5 * (len(words) + 1), [0, 1, 1.8, 2.5]

    def p(w, k, own):
        n, size = max(count[k][w] - own, 0), sum(count[k].values())
        return max(n - drop[min(n, 3)], 0) / size + sum(min(x, drop[min(x, 3)]) for x in count[k].values()) / size * (left[w] + 0.5) / total

    def plain(text, label):
        ws = {w if w in words else None for w in re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text))}
        r = [np.log(p(w, 0, int(label == 1))) - np.log(p(w, 1, int(label == 0)))
             if count[0][w] > (label == 1) or count[1][w] > (label == 0) else 0.0 for w in ws]
        over = sum(max(x - 1.5, 0) ** 2 for x in r)
        return [sum(r) / len(r), (over / len(r)) ** 0.5, np.log1p(over / len(r) ** 0.5)]

    known = [(plain(t, train[i]), train[i]) for i, t in rows if i in train]
    curve = X.logistic(np.array([x for x, _ in known]), np.array([float(y) for _, y in known]))
    got = {r.doc_id: r.score for r in X.score(docs, model).collect()}
    for i, t in rows:
        assert abs(got[i] - float(curve(np.array([plain(t, None)]))[0])) < 1e-6


def test_no_training_rows_and_empty_tables(docs_of, spark):
    docs = docs_of([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in X.score(docs, X.fit(docs, none)).collect()} == {0.0}
    empty = docs_of([])
    assert X.score(empty, X.fit(empty, none)).collect() == []


def test_clashing_columns_are_replaced(docs_of, spark):
    docs = docs_of([(1, "a")]).selectExpr("*", "7 as score", "'x' as toxic", "1 as cell")
    out = X.score(docs, X.fit(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")))
    assert out.columns.count("score") == 1 and out.collect()[0].toxic == "x"
