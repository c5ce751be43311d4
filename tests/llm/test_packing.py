import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from support import documents, odd_rows, prose

from tillmark.llm import bpe, packing
from tillmark.llm.packing import Limits, Packer, Piece


def check(sequences, sizes, limits):
    """Every token once, every limit held; returns the shares of tokens used."""
    parts = defaultdict(list)
    for made in sequences:
        assert 0 < sum(p.length for p in made) <= limits.tokens
        assert len(made) <= limits.segments and sum(p.loss for p in made) <= limits.loss
        for p in made:
            parts[p.owner].append(p)
    for i, (tokens, loss) in enumerate(sizes):
        at = 0
        for p in sorted(parts[i], key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == tokens and sum(p.loss for p in parts[i]) == loss
    return sum(t for t, _ in sizes) / (len(sequences) * limits.tokens)


@pytest.mark.parametrize("seed", range(4))
def test_limits_hold_and_little_is_padded(seed):
    rng = random.Random(seed)
    sizes = [(t := rng.choice([1, 3, 50, 400, 900, 2048, 5000]) + rng.randrange(60), rng.randrange(t + 1)) for _ in range(600)]
    assert check(packing.pack_examples(sizes, Limits()), sizes, Limits()) > 0.98
    tight = Limits(tokens=512, segments=4, loss=200)
    check(packing.pack_examples(sizes, tight), sizes, tight)


def test_examples_that_fit_are_not_cut_without_leave():
    sizes = [(300, 100)] * 50 + [(900, 10)] * 20
    limits = Limits(tokens=1000, least=0)
    made = packing.pack_examples(sizes, limits)
    check(made, sizes, limits)
    assert all(p.start == 0 for s in made for p in s) and len(made) < 50


def test_dot_product_prefers_demand_in_line_with_room():
    packer = Packer(Limits(tokens=100, segments=10, loss=100, least=0))
    for i, (t, loss) in enumerate([(50, 50), (50, 0), (60, 5)]):
        list(packer.add(Piece(i, 0, t, loss)))
    first = next(packer.pack())
    assert [p.owner for p in first] == [0, 1]  # 60 + 5 has less value than 50 + 50 while all is free


def test_segment_limit_binds_on_many_tiny_texts():
    sizes = [(2, 2)] * 1000 + [(1500, 1500)] * 5
    limits = Limits(tokens=2048, segments=50)
    check(packing.pack_examples(sizes, limits), sizes, limits)


def test_an_open_sequence_is_handed_on():
    packer = Packer(Limits(tokens=10, least=1))
    list(packer.add(Piece(0, 0, 4, 4)))
    assert list(packer.pack(keep_open=True)) == [] and packer.tokens == 4
    list(packer.add(Piece(1, 0, 6, 6)))
    assert [len(s) for s in packer.pack()] == [2]


@pytest.mark.parametrize("chunk", [1 << 21, 500])
def test_pieces_of_documents(spark, chunk):
    rows = odd_rows() + [(50 + i, prose(i, 40 * i, 10**6)) for i in range(1, 30)]
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    got = packing.pack(documents(spark, rows, clashes=True), bpe.vocabulary(), chunk=chunk).collect()
    library = bpe.encoder(bpe.vocabulary()).library
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for made in by_sequence.values():
        at = 0
        for r in sorted(made, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by_sequence) <= total / 2048 + 5


def test_loss_column_binds(spark):
    rows = [(i, prose(i, 60), None, None, loss) for i, loss in enumerate([30, 0, None, 500, -3] * 30)]
    rows.append((150, prose(150, 3000), None, None, 900))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, bears long").coalesce(1)
    limits = Limits(tokens=2048, loss=256)
    got = packing.pack(docs, bpe.vocabulary(), limits, loss="bears").collect()
    sizes = {r.doc_id: r.doc_tokens for r in got}
    by_doc, by_sequence = defaultdict(int), defaultdict(lambda: [0, 0])
    for r in got:
        by_doc[r.doc_id] += r.loss_tokens
        by_sequence[r.sequence_id][0] += r.length
        by_sequence[r.sequence_id][1] += r.loss_tokens
    assert by_doc == {i: min(max(sizes[i] if loss is None else loss, 0), sizes[i]) for i, _, _, _, loss in rows}
    assert all(tokens <= 2048 and loss <= 256 for tokens, loss in by_sequence.values())
    assert sum(loss == 256 for _, loss in by_sequence.values()) > 5  # full by loss, not by tokens
    free = packing.pack(docs, bpe.vocabulary(), loss="bears").select("sequence_id").distinct().count()
    assert len(by_sequence) > free
    assert "loss_tokens" not in packing.pack(docs, bpe.vocabulary()).columns


def test_repeated_rows_and_empty_table(spark):
    got = packing.pack(documents(spark, odd_rows()), bpe.vocabulary()).collect()
    assert sum(r.start == 0 for r in got) == len(odd_rows())
    assert packing.pack(documents(spark, []), bpe.vocabulary()).collect() == []
    with pytest.raises(ValueError):
        Limits(tokens=0)
