import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from support import documents, odd_rows, prose

from tillmark.llm import simhash as s
from tillmark.llm.components import components

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_print(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + length]) for i in range(len(words) - length + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=3):
    """Smallest position each position reaches."""
    low = list(range(len(prints)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= bits:
            a, b = sorted((root(i), root(j)))
            low[b] = a
    return [root(i) for i in range(len(prints))]


def test_code_is_the_golay_code():
    errors, extra, single = s._code()
    every = np.arange(1 << 12) << 11
    words = every ^ s.syndromes(every, single)
    weights = Counter(np.bitwise_count(words).tolist())
    assert weights == {0: 1, 7: 253, 8: 506, 11: 1288, 12: 1288, 15: 506, 16: 253, 23: 1}
    assert sorted(Counter(np.bitwise_count(errors).tolist()).items()) == [(0, 1), (1, 23), (2, 253), (3, 1771)]


def test_words_one_bit_apart_share_an_index():
    rng = np.random.default_rng(0)
    u = rng.integers(0, 1 << 23, 4000)
    for bit in range(23):
        v = u ^ (1 << bit)
        (a, count_a), (b, count_b) = s.indices(u), s.indices(v)
        same = (a[:, :, None] == b[:, None, :]) & count_a[:, :, None] & count_b[:, None, :]
        assert same.any(axis=(1, 2)).all()


def test_prints_three_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1)
    v = u.copy()
    for i in range(len(v)):
        for bit in rng.choice(64, i % 4, replace=False):
            v[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [set(zip(*(x.tolist() for x in s.keys(z)), strict=True)) for z in (u, v)]
    assert {row for _, row in keys[0] & keys[1]} == set(range(len(u)))


def test_fingerprints_equal_brute_force(monkeypatch):
    monkeypatch.setattr(s, "_SLICE", 7)
    for text in [t for _, t in odd_rows() if t is None or len(t) < 1000] + [prose(i, 3 * i) for i in range(12)] + ["A b", "É A"]:
        assert s.fingerprint(text) == brute_print(text), text


def test_components_equal_brute_force(spark):
    base = [prose(i, 60, 90) for i in range(25)]
    rows = [(i * 7 + 3, t) for i, t in enumerate(base)] + [(500 + i, t + " tail") for i, t in enumerate(base)]
    rows += [(900 + i, t.replace("w1", "w2")) for i, t in enumerate(base)] + [r for r in odd_rows() if r[0] is not None]
    rows.sort(key=lambda r: r[0])
    got = s.near_duplicates(documents(spark, rows, clashes=True)).collect()
    low = brute_groups([brute_print(t) if t is None or len(t) < 1000 else s.fingerprint(t) for _, t in rows])
    want = Counter((i, rows[at][0]) for (i, _), at in zip(rows, low, strict=True))
    assert Counter((r["key"], r["component"]) for r in got) == want


def test_dense_groups_give_a_forest(spark):
    prints = np.array([1 << b for b in range(40)] + [0], np.int64)  # all within two bits: 820 pairs
    df = spark.createDataFrame([(int(p),) for p in prints], "print long")
    links = s.links(df).collect()
    assert {r.label for r in components(s.links(df)).collect()} == {0}
    assert 40 <= len(links) < 400


def test_long_chains_end_in_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 100), (201, 200), (200, 201)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert {got[i] for i in range(71)} == {0} and got[100] == 100 and got[201] == 200


def test_one_document_of_each_group_stays(spark):
    rows = odd_rows()
    df = documents(spark, rows, clashes=True)
    kept = s.keep_one(df)
    assert kept.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    groups = {}
    for i, t in rows:
        groups.setdefault(s.fingerprint(t), []).append((i, t))
    assert all(n == 1 for n in got.values())
    assert got[5, "same text"] == 1 and (6, "same text") not in got and (7, dict(rows)[7]) in got and (8, dict(rows)[8]) not in got
    assert len(got) <= len(groups)


def test_null_keys_and_empty_tables(spark):
    got = s.near_duplicates(documents(spark, [(None, "only this"), (None, "only this")])).collect()
    assert [(r["key"], r["component"]) for r in got] == [(None, None)] * 2
    assert s.near_duplicates(documents(spark, [])).collect() == []
    assert s.keep_one(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        s.links(spark.createDataFrame([], "print long"), 4)


def one_key(n, seed):
    """Fingerprints whose first two segments are the codeword 0."""
    rng = np.random.default_rng(seed)
    return rng.choice(1 << 21, n, replace=False).astype(np.uint64) << np.uint64(43)


def test_a_hot_key_is_handed_on_in_blocks():
    prints = np.sort(one_key(50_000, 1).view(np.int64))
    batches = [pa.record_batch({"key": np.full(5_000, 7), "print": prints[i : i + 5_000]}) for i in range(0, 50_000, 5_000)]
    batches.append(pa.record_batch({"key": [7, 8, 8], "print": [1, 1, 3]}))
    made = list(s._meet(batches, 3, 4096))
    late = [m for m in made if (m["block"] >= 0).all()]
    assert max(len(m["a"]) for m in late) <= 5_000 and np.concatenate([m["a"] for m in late]).tolist() == [*prints.tolist(), 1]
    blocks = np.concatenate([m["block"] for m in late])
    assert np.bincount(blocks).max() == 4096 and (np.diff(blocks) >= 0).all()
    rest = [m for m in made if (m["block"] < 0).all()]
    assert [(a, b) for m in rest for a, b in zip(m["a"].tolist(), m["b"].tolist())] == [(1, 3)]


@pytest.mark.parametrize("n, hot, rows", [(1_500, 100, 200), (12_000, 1_024, 2_000)])
def test_components_of_a_hot_key(spark, n, hot, rows):
    prints = one_key(n, 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        df = spark.createDataFrame([(p,) for p in prints.view(np.int64).tolist()], "print long")
        got = {r.node: r.label for r in components(s.links(df, hot=hot)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    a, b = s._forest(prints, 3)
    low = list(range(n))
    for i, j in zip(a, b):  # each fingerprint is reached once, from one that was reached before
        low[j] = low[i]
    groups = {}
    for i, p in enumerate(prints.view(np.int64).tolist()):
        groups.setdefault(low[i], []).append(p)
    want = {p: min(g) for g in groups.values() if len(g) > 1 for p in g}
    assert got == want
