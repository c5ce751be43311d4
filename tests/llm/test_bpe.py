import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from support import documents, odd_rows

from tillmark.llm import bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(bpe.vocabulary())


def reference(coder, text):
    return coder.library.encode(text or "", add_special_tokens=False).ids


HOSTILE = [
    "", " ", "<|endoftext|>", "x<|endoftext|>y <|startoftext|><|endoftext|>'s", "<|ENDOFTEXT|>", "aaaa'sss'reeee'LL", "İstanbul ſ ΟΔΥΣΣΕΥΣ ǅ",
    "é é ́ ﬁ ½ ٣ 가 한", "a\x1cb\x85c d　e\xa0f", "a" * 3000, "ab" * 500 + "!?" * 300, "​﻿", "x\x00y", "😀👍🏽",
]


def test_texts_are_encoded_as_the_library_does(coder):
    rng = random.Random(3)
    alphabet = "abcdeéèüßΣİ'stre  \n\x0b<|>!?#12３ªا中あ́ \x85\x1c"
    texts = HOSTILE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["".join(rng.choice("aeinthr") for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        want = reference(coder, text)
        assert ids.tolist() == want, text
        assert coder.decode(ids) == coder.library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(coder, text):
    assert next(iter(coder.encode([text]))).tolist() == reference(coder, text)


def test_every_code_point_of_the_plain_range(coder):
    texts = [f"a{chr(i)}b {chr(i)}" for i in range(1, 0x250)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids.tolist() == reference(coder, text), text


def test_pairs_are_compatible_just_when_merging_keeps_them(coder):
    rng = np.random.default_rng(5)
    inner = {i: t for t, i in coder.inner.items()}
    final = {i: t for t, i in coder.final.items()}
    a, b = rng.choice(list(inner), 3000), rng.choice([*inner, *final], 3000)
    last = np.array([i in final for i in b])
    good = coder.compatible(a[last], b[last])
    want = [coder.merged(inner[x] + final[y]) == [x, y] for x, y in zip(a[last].tolist(), b[last].tolist(), strict=True)]
    assert good.tolist() == want and 0 < good.sum() < len(good)


def test_long_and_short_merging_agree(coder):
    rng = random.Random(9)
    for _ in range(300):
        piece = "".join(rng.choice("aehinrst") for _ in range(rng.randrange(1, 60))).encode()
        row = [coder.inner[piece[i : i + 1]] for i in range(len(piece) - 1)] + [coder.final[piece[-1:]]]
        assert coder._merged_long(row) == coder.merged(piece)


def test_long_texts_are_cut_at_blanks_only():
    raw = b"word " * 50 + b"x" * 300 + b"\nend"
    assert b"".join(bpe.segments(raw, 40)) == raw
    assert all(p.split() for p in bpe.segments(raw, 40)) and len(list(bpe.segments(raw, 40))) > 3


def test_small_caches_change_nothing(coder, monkeypatch):
    monkeypatch.setattr(bpe, "_GENERATION", 5)
    fresh = bpe.WordBpe(bpe.vocabulary())
    texts = [f"one two{i} three four{i % 3}, five" for i in range(50)]
    for _ in range(2):
        assert [x.tolist() for x in fresh.encode(texts)] == [reference(coder, t) for t in texts]


def test_query_columns(spark, coder):
    rows = odd_rows()
    got = bpe.tokenise(documents(spark, rows, clashes=True), bpe.vocabulary()).collect()
    want = []
    for i, t in rows:
        ids = reference(coder, t)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), coder.library.decode(ids, skip_special_tokens=False))]
        want.append((i, len(ids), *sha))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.tokenise(documents(spark, []), bpe.vocabulary()).collect() == []
