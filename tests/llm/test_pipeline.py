"""The pipeline against brute-force versions of its stages, on a planted corpus."""

import random
import re
from collections import defaultdict

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_pii import brute as private
from tests.llm.test_simhash import brute as linked

corpus_pipeline = pytest.importorskip("corpus_pipeline")
LABEL = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def corpus():
    r = random.Random(11)
    words = [a + b for a in ("th", "an", "er", "ou", "st", "Ä", "ing") for b in ("e", "tion", "al", "ß", "or", "est", "ly", "um")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs, labels, items = [], [], [(i, text(30)) for i in range(5)]
    for i in range(240):
        t = text(r.randrange(40, 160)).split()
        toxic = i % 6 == 0
        for _ in range(1 + len(t) // 15 if toxic else 0):
            t.insert(r.randrange(len(t)), r.choice(["scum", "idiot", "moron"]))
        if i % 17 == 1:
            t[3:3] = [f"mail{i}@host.example.com", "+1 (705) 555-6638"]
        if i % 23 == 2:
            t[5:5] = items[i % 5][1].split()
        docs.append((i, " ".join(t), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[7 + i][1], "en", "s", 0) for i in range(12)]                 # exact copies
    docs += [(2000, None, "en", "s", None), (2001, "", "en", "s", 0), (None, text(60), None, None, None), docs[9]]
    docs.append((3000, text(4000), "en", "s", 0))
    return docs, labels, items


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    docs, labels, items = corpus()
    home = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    return home, docs, items


def mask(text):
    """Base spans generalised; overlapping spans as one, named after the first."""
    spans = sorted((s, e, k) for k, s, e in private(text))
    merged = []
    for s, e, k in spans:
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], e), merged[-1][2])
        else:
            merged.append((s, e, k))
    for s, e, k in reversed(merged):
        text = text[:s] + LABEL[k] + text[e:]
    return text


def test_run_equals_brute_force(spark, made):
    home, docs, items = made
    rows = [(i, t) for i, t, *_ in docs if not re.search(r"\b(scum|idiot|moron)\b", t or "")]
    named = {c for _, _, c in linked(rows) if c is not None}
    kept = {i: t for i, t in rows if i in named} | {None: next(t for i, t in rows if i is None)}
    hit = {d for d, *_ in contaminated(list(kept.items()), items)}
    want = {i: mask(t or "") for i, t in kept.items() if i not in hit}
    assert hit and 0 < len(want) < len(rows)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    length = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in want.items()}
    got, sequences = defaultdict(list), defaultdict(list)
    for p in corpus_pipeline.run(spark, home).collect():
        got[p.doc_id].append((p.piece, p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: sum(n for _, _, n in ps) for i, ps in got.items()} == length
    assert all(sum(n for _, n in s) <= 1024 for s in sequences.values())
    assert len(sequences) <= -(-sum(length.values()) // 1024) + 1


def test_stages_return_the_columns_of_documents(spark, made):
    home, _, _ = made
    docs = spark.read.parquet(f"{home}/documents.parquet").selectExpr("*", "1 as score", "2 as fp", "3 as _key")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, home).columns == docs.columns, name


def test_empty_tables(spark, tmp_dir):
    docs, labels, items = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int", "item_id long, text string"
    for name, schema in (("documents", docs), ("labels", labels), ("benchmark", items)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []
