import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from staykit.llm.quality import measure, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t))}
    for n in (3, 5, 10):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        c = Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if c[g] > 1 for j in range(n)}
        out[f"words_{n}"] = len(inside)
        out[f"chars_{n}"] = sum(len(words[i]) for i in inside)
    seen, dup, chars = set(), 0, 0
    for line in t.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    return out | {"n_dup_lines": dup, "chars_lines": chars}


def made(seed):
    r = random.Random(seed)
    words = ["the", "of", "Ärger", "été", "a|b", "***", "x", "über", "😀😀", "&amp"]
    texts = [None, "", "\n\n", "one", "a\na", "a\na\na ", "\r\n x \r\n", "x " * 500, "\n".join(["same line"] * 9)]
    for _ in range(60):
        lines = [" ".join(r.choice(words) for _ in range(r.randrange(0, 14))) for _ in range(r.randrange(1, 12))]
        lines += [r.choice(lines) for _ in range(r.randrange(4))]
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_against_brute_force(seed):
    texts = made(seed)
    got = measure(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute(t), t


def test_query_rows(docs_of):
    texts = made(3) + [" ".join(f"w{i}" for i in range(200))]
    got = rules(docs_of(list(enumerate(texts)) + [(None, "x")])).collect()
    assert len(got) == len(texts) + 1
    for g in got:
        b = brute(texts[g.doc_id]) if g.doc_id is not None else brute("x")
        failed = b["n_words"] < 50 or 100 * b["words_3"] > 50 * b["n_words"]
        assert (g.n_words, g.n_repeat_words, g.n_dup_lines, g.base_failed) == (b["n_words"], b["words_3"], b["n_dup_lines"], failed)
        assert not (failed and g.kept)
    assert next(g for g in got if g.doc_id == len(texts) - 1).kept


def test_empty_table(docs_of):
    assert rules(docs_of([])).collect() == []
