import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from staykit.llm import pii
from staykit.llm.pii import disclosing, report, sanitise, spans, texts

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, d[::-1])))
        return 16 <= len(d) <= 19 and s % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def made(seed):
    r = random.Random(seed)
    bits = ["a@b.c", "é", "x.y%z@mail-7.example.com", "@", "..", "a@b", "192.168.0.1", "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.255.256",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004", "+1 (705) 555-6638", "+44.20.7946.0958", "+12", "++1 2 3 4 5 6 7 8 9",
            "😀", " ", "\n", "-", "word", "12", "7 8", "+", "a@b.c_d@e.f", "1" * 40, "%@-.-", "a" * 30]
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "a" * 20000), (3, "1" * 20000 + "-" + "2 " * 9000), (4, "a@b.c " * 300), (5, "+1" + " " * 5000)]
    rows += [(10 + i, "".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randrange(1, 25)))) for i in range(150)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans_against_python(docs_of, seed):
    rows = made(seed)
    got = report(docs_of(rows)).collect()
    want = []
    for i, t in rows:
        b = brute(t)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        want.append((i, *(sum(k == x for x, _, _ in b) for k in BASE), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((tuple(g)[:6] for g in got), key=str) == sorted(want, key=str)
    text = dict((g.doc_id, g) for g in got)
    assert all(g.spans.startswith(",".join(f"{k}:{s}:{e}" for k, s, e in brute(t))) for (i, t), g in zip(rows, (text[i] for i, _ in rows)) if i and i > 9)


def corpus():
    r = random.Random(4)
    words = ["the", "of", "and", "house", "blue", "rain"]
    rows = [(i, " ".join(r.choice(words) for _ in range(40))) for i in range(300)]
    for i in range(4):                                    # Zorblax stands by one address only
        rows.append((1000 + i, " ".join(r.choice(words) for _ in range(9)) + " Zorblax the owner jo@mail.example.com " + str(i) + " " + rows[i][1]))
    rows += [(2000 + i, rows[5][1] + " Quuxly pat@mail.example.com") for i in range(5)]        # copies: one piece of evidence
    return rows


def test_disclosing_terms_become_spans_and_copies_are_one_text(docs_of):
    rows = corpus()
    got = {g.doc_id: g for g in spans(docs_of(rows)).collect()}
    for i, t in rows:
        terms = [t[s.start:s.end] for s in got[i]["all"] if s.kind == "term"]
        assert terms == (["Zorblax", "owner"] if 1000 <= i < 2000 else [])


def test_copies_of_a_text_do_not_hide_its_terms(docs_of):
    rows = corpus()
    rows += [(3000 + i, rows[300][1]) for i in range(200)]
    got = {g.doc_id: g for g in spans(docs_of(rows)).collect()}
    for i in (1000, 1001, 3000):
        assert [s.value for s in got[i]["all"] if s.kind == "term"] == ["zorblax", "owner"]


def test_disclosing_terms_far_away_and_without_the_entity(docs_of):
    rows = corpus()
    far = " the of" * 40
    for i in range(4):
        rows.append((4000 + i, f"Vantor{far} and kim@mail.example.com {i}{far} VANTOR, vantor's; Vantors kimvantor@x.org{i}"))
    rows.append((5000, "rain and vantor in the house"))
    got = {g.doc_id: g for g in spans(docs_of(rows)).collect()}
    text = dict(rows)
    for i in range(4000, 4004):
        assert [text[i][s.start:s.end] for s in got[i]["all"] if s.kind == "term"][:3] == ["Vantor", "VANTOR", "vantor"]
    assert [(s.kind, s.start, s.end, s.value) for s in got[5000]["all"]] == [("term", 9, 15, "vantor")]
    clean = {g.doc_id: g.text for g in sanitise(docs_of(rows)).collect()}
    assert clean[5000] == "rain and [TERM] in the house"
    assert not any("vantor " in clean[i].lower() for i in range(4000, 4004))


def test_pairs_against_a_plain_count(docs_of):
    r = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    owner = {w: f"{w}@x.org" for w in words[:12]}
    rows = []
    for i in range(250):
        t = [r.choice(words[12:]) for _ in range(r.randrange(0, 12))]
        if i % 3 == 0:
            w = r.choice(words[:12])
            t += [w] * (r.random() < 0.9) + [owner[w]] * (r.random() < 0.9)
            r.shuffle(t)
        rows += [(i, " ".join(t))] * (1 + 5 * (i % 7 == 0))
    known = texts(docs_of(rows))
    got = {tuple(p) for p in disclosing(known, 0.7, 2).collect()}
    held = [(set(re.findall(r"(?<!\S)w\d+(?!\S)", t)), {"email:" + m.group() for m in re.finditer(BASE["email"], t)}) for t in {t for _, t in rows}]
    n = len(held)
    want = set()
    for e in {e for _, es in held for e in es}:
        n_e = sum(e in es for _, es in held)
        for t in {t for ts, _ in held for t in ts}:
            n_t, n_et = sum(t in ts for ts, _ in held), sum(t in ts and e in es for ts, es in held)
            if n_et >= 2 and math.log(n * n_et / (n_e * n_t)) >= 0.7 * math.log(n / n_e):
                want.add((e, t))
    assert got == want and len(want) > 5


def test_sanitised_text_and_clean_rows(docs_of):
    rows = corpus() + [(1, "call +1 (705) 555-6638 or 4111 1111 1111 1111"), (2, None), (2, None), (None, "a@b.c at 10.0.0.1")]
    docs = docs_of(rows).selectExpr("*", "'keep' as key", "1 as base")
    got = sanitise(docs)
    assert got.columns == docs.columns
    got = got.collect()
    assert len(got) == len(rows)
    text = {g.text: g for g in got}
    assert "call [PHONE] or [CARD]" in text and "[EMAIL] at [IP]" in text
    assert text["[EMAIL] at [IP]"].n_chars == len("[EMAIL] at [IP]")
    before = sorted(t for i, t in rows if t and not brute(t))
    assert before == sorted(g.text for g in got if g.text and "[" not in g.text)
    assert sum("[TERM] the [TERM] [EMAIL]" in (g.text or "") for g in got) == 4
    assert sum(g.text is None for g in got) == 2


def test_empty_table(docs_of):
    assert report(docs_of([])).collect() == [] and sanitise(docs_of([])).collect() == []


def test_spans_of_one_text_take_linear_time(docs_of):
    import time

    text = " ".join(f"10.{i // 65536}.{i // 256 % 256}.{i % 256}" for i in range(12_000))
    docs = docs_of([(1, text), (2, "none")])
    start = time.perf_counter()
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    assert got[1].n_ip == 12_000 and got[2].n_ip == 0
    ends = [m.span() for m in re.finditer(r"[0-9.]+", text)]
    assert got[1].spans == ",".join(f"ip:{a}:{z}" for a, z in ends)
    assert pii.sanitise(docs).where("doc_id = 1").first().text == " ".join(["[IP]"] * 12_000)
    assert time.perf_counter() - start < 60


def test_unions_across_parts(spark):
    import random

    rnd = random.Random(4)
    for n in (0, 1, 63, 64, 65, 400):
        spans = []
        for _ in range(n):
            a = rnd.randint(0, 6 * n)
            spans.append(("ip", a, a + rnd.choice([1, 2, 3, 9, 200]), "x"))
        df = spark.createDataFrame([(spans,)], "c array<struct<kind:string,start:int,end:int,value:string>>")
        got = [(r.start, r.end) for r in df.select(F.expr(pii._union("c")).alias("u")).first().u]
        want = []
        for _, a, z, _ in sorted(spans, key=lambda s: (s[1], s[2])):
            if want and a < want[-1][1]:
                want[-1] = (want[-1][0], max(want[-1][1], z))
            else:
                want.append((a, z))
        assert got == want


def test_broadcast_or_not_the_result_is_the_same(docs_of, monkeypatch):
    rows = [(i, f"Write to jo{i // 2}@x.org about zebra{i // 2} and quagga now, please {i}") for i in range(40)] + [(i, f"plain words {i}") for i in range(100, 160)]
    docs = docs_of(rows)
    results = []
    for most in (16 << 20, -1):
        monkeypatch.setattr(pii, "BROADCAST_BYTES", most)
        results.append((sorted(map(str, pii.report(docs).collect())), sorted(map(str, pii.sanitise(docs).collect()))))
    assert results[0] == results[1] and any("term:" in r for r in results[0][0])
