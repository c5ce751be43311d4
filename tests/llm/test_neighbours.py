import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tillmark.llm import neighbours as s
from tillmark.llm.neighbours import Index

SCHEMA = "vec_id long, embedding array<double>, entry string, `rank` int"


def table(spark, rows):
    exact = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", None) for i, v in rows]
    return spark.createDataFrame(exact, SCHEMA)


def brute(rows, every, k):
    """Exact lists of (id, rank, id, score) over usable rows of the most common length."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    sizes = [len(v) for _, v in good]
    size = min(sizes, key=lambda n: (-sizes.count(n), n))
    good = [(i, v) for i, v in good if len(v) == size]
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted(((-math.fsum(a * b for a, b in zip(v, x, strict=True)), i) for i, x in good if i != q))
            out += [(q, n + 1, i, -d) for n, (d, i) in enumerate(scored[:k])]
    return out


def grid(seed, n, size=6):
    """Small whole numbers: inner products are exact, ties are many."""
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(seed).integers(-3, 4, (n, size)))]


def test_exact_when_all_cells_are_visited(spark):
    rows = grid(1, 300) + [(1000 + i, [1.0, 2, 3, 0, 0, 1]) for i in range(60)]
    got = s.nearest(table(spark, rows), 20, 20, Index(centroids=4, share=1.0, least=1, block=64, queries=7))
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 20, 20))


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = grid(2, 45, 3) + [(100, None), (120, []), (140, [0.0, 0, 0]), (160, [nan, 1, 1]), (180, [1.0, inf, 0]), (200, [1.0, None, 2])]
    rows += [(220, [1.0, 2]), (None, [1.0, 1, 1]), (0, rows[0][1]), (20, rows[20][1])]
    got = s.nearest(table(spark, rows), 20, 20, Index(share=1.0)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 20, 20))


def test_few_candidates_and_empty_tables(spark):
    got = s.nearest(table(spark, [(0, [1.0, 0.5]), (1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    empty = s.nearest(table(spark, []))
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
    assert s.nearest(table(spark, [(20, [2.0])])).collect() == []


@pytest.mark.parametrize("n", [600, 3000])
def test_recall_of_the_default_index(spark, n):
    rng = np.random.default_rng(n)
    vectors = rng.normal(size=(n, 16)) + 2 * rng.normal(size=(20, 16))[rng.integers(0, 20, n)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = {}
    for r in s.nearest(table(spark, rows)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = {}
    for q, _, i, _ in brute(rows, 20, 20):
        want.setdefault(q, set()).add(i)
    assert np.mean([len(found[q] & w) / len(w) for q, w in want.items()]) >= 0.9


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=7), st.lists(st.integers(-9, 9), min_size=1, max_size=7))
def test_cells_come_by_summed_distance(first, second):
    a, b = np.array(first, float), np.array(second, float)
    pairs = list(s.cells_by_distance(a, b))
    assert len(set(pairs)) == len(pairs) == len(a) * len(b)
    sums = [a[i] + b[j] for i, j in pairs]
    assert sums == sorted(sums)
