import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staykit.llm.packing import Encoder, best_fit, improve, pack

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def whole():
    t = Tokenizer.from_file(FILES[0])
    return lambda text: t.encode(text, add_special_tokens=False).ids


def texts():
    r = random.Random(3)
    words = ["the", "Ärger", "été", "l'été", "42", "...", "\n\n", "  ", "ñ", "don't", "<|endoftext|>", "a", "“x”"]
    out = ["", "x" * 5000, " ", "日本語 😀 text", "é" * 3000, "\x00\x01", " ́a"]
    return out + ["".join(r.choice(words) + r.choice(["", " "]) for _ in range(r.randrange(1, 900))) for _ in range(150)]


def test_both_encoders_agree():
    encode, slow = Encoder(*FILES), whole()
    for t in texts():
        assert encode(t) == slow(t)


def test_a_special_token_in_a_text_is_that_token():
    assert Encoder(*FILES)("<|endoftext|> x") == whole()("<|endoftext|> x") == [50256, 2124]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 99), min_size=0, max_size=80))
def test_bins_hold_every_piece_once(lengths):
    n = np.array(lengths, np.int64)
    first = best_fit(n, 100)
    after = improve([list(b) for b in first], n, 100)
    assert len(after) <= len(first)
    for bins in (first, after):
        assert sorted(i for b in bins for i in b) == list(range(len(n)))
        assert all(n[b].sum() <= 100 for b in bins)


def test_local_search_beats_best_fit():
    n = np.random.default_rng(0).integers(200, 700, 3000)
    first = best_fit(n, 1024)
    after = improve([list(b) for b in first], n, 1024)
    assert len(after) < len(first)


@pytest.mark.parametrize("seed", range(4))
def test_no_exchange_helps_at_the_end(seed):
    n = np.random.default_rng(seed).integers(23, 48, 90)
    bins = improve(best_fit(n, 100), n, 100)
    if len(bins) == -(-n.sum() // 100):
        return

    def some(b):
        return [(0, 0)] + [(1, int(n[i])) for i in b] + [(2, int(n[i] + n[j])) for x, i in enumerate(b) for j in b[x + 1:]]

    for a in bins:
        for b in bins:
            if a is not b:
                for k, x in some(a):
                    for j, y in some(b):
                        if (k, j) in ((1, 0), (1, 1), (2, 1), (1, 2)) and x > y and n[b].sum() + x - y <= 100:
                            assert n[b].sum() - n[a].sum() + x - y <= 0


def test_full_pieces_stay_outside_the_cells(docs_of):
    got = pack(docs_of([(1, " the" * 30_000), (2, "short")]), *FILES, cell_pieces=1)
    full = [g for g in got.collect() if g.length == 1024]
    assert len(full) > 5 and len({g.sequence_id for g in full}) == len(full) and min(g.sequence_id for g in full) >= 2 << 32


def least_bins(n, size=1024):
    """A lower bound of Martello and Toth: pieces above half a bin need one each, and leave only so much room."""
    best = -(-int(n.sum()) // size)
    for a in range(size // 2 + 1):
        big, mid, small = n[n > size - a], n[(n > size // 2) & (n <= size - a)], n[(n >= a) & (n <= size // 2)]
        best = max(best, len(big) + len(mid) + max(0, -(-(int(small.sum()) - len(mid) * size + int(mid.sum())) // size)))
    return best


@pytest.mark.parametrize("cell", [20_000, 60])
def test_round_trip(docs_of, cell):
    slow = whole()
    rows = list(enumerate(texts())) + [(None, None), (1, "x" * 5000), (2**60 + 1, "again"), (2**60 + 1, "again")]
    got = pack(docs_of(rows), *FILES, cell_pieces=cell).collect()
    by = defaultdict(list)
    for g in got:
        by[g.doc_id].append((g.start, g.piece, g.length, g.ids_crc32))
    want = defaultdict(list)
    for i, t in rows:
        ids = [*slow(t or ""), 2]
        cut = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        starts = [0, *range(cut, len(ids), 1024)]
        for p, (a, z) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[i].append((a, p, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for g in got:
        sequences[g.sequence_id].append((g.offset, g.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == list(np.cumsum([0] + [n for _, n in s[:-1]])) and sum(n for _, n in s) <= 1024
    if cell > 1000:
        n = np.array([g.length for g in got])
        assert len(sequences) <= (n == 1024).sum() + least_bins(n[n < 1024]) + 1


def test_empty_table(docs_of):
    assert pack(docs_of([]), *FILES).collect() == []
