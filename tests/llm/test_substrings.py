import duckdb
import numpy as np
import pytest
from support import documents, odd_rows, prose

from tillmark.llm import substrings as s
from tillmark.llm.substrings import Shape

SMALL = Shape(k=6, m=2, hot=4000)


def brute(rows, k):
    """(key, text) -> (words, removed, kept)."""
    split = [(i, t, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, _, w in split:
        for at in range(len(w) - k + 1) if i is not None else ():
            own = tuple(w[at : at + k])
            first[own] = min(i, first.get(own, i))
    out = {}
    for i, t, w in split:
        gone = np.zeros(len(w), bool)
        for at in range(len(w) - k + 1) if i is not None else ():
            if first[tuple(w[at : at + k])] < i:
                gone[at : at + k] = True
        out[i, t] = (len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


def compare(spark, rows, shape, clashes=False):
    got = s.deduplicate(documents(spark, rows, clashes), shape, ("doc_id", "text")).collect()
    want = brute(rows, shape.k)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept) == want[r.doc_id, r.text], r.doc_id
    return got


def copies(seed=0, n=40):
    rng = np.random.default_rng(seed)
    passages = [prose(900 + i, 15) for i in range(4)]
    rows = []
    for i in range(n):
        parts = [prose(int(rng.integers(10**6)), int(rng.integers(0, 30)), 12), passages[int(rng.integers(4))], prose(i, 5)]
        rows.append((int(rng.integers(200)), " ".join(parts)))
    return rows + [(300, rows[0][1]), (301, rows[0][1]), (301, rows[0][1])]


@pytest.mark.parametrize("hot", [4000, 1, 5])
def test_equal_to_brute_force(spark, hot):
    got = compare(spark, copies() + odd_rows(), Shape(k=6, m=2, hot=hot), clashes=True)
    assert sum(r.n_removed for r in got) > 300


@pytest.mark.parametrize("shape", [Shape(k=1, m=1), Shape(k=5, m=5), Shape(k=9, m=1)])
def test_other_shapes(spark, shape):
    compare(spark, copies(3, 15), shape)


def test_production_shape_and_parts(spark, monkeypatch):
    passage = prose(5, 60, 10**6)
    rows = [(1, prose(1, 200) + " " + passage), (2, passage + " " + prose(2, 70)), (3, passage), (4, prose(9, 49)), (5, prose(9, 49))]
    got = {r.doc_id: r.n_removed for r in compare(spark, rows, Shape())}
    assert got == {1: 0, 2: 60, 3: 60, 4: 0, 5: 0}
    monkeypatch.setattr(s, "_PART", 16)
    found = (prose(4, 120)).encode().split()
    parts = [(int(a), int(n)) for _, start, size in s.super_kmers(found, Shape(10, 3)) for a, n in zip(start, size, strict=True)]
    assert sum(n for _, n in parts) == 111 and [a for a, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()


def test_minimisers_are_minima():
    found = prose(6, 80).encode().split()
    wide, runs = s.minimisers(found, Shape(10, 3)), s.minimisers(found, Shape(3, 3))
    assert wide.tolist() == [runs[i : i + 8].min() for i in range(len(wide))]


def test_empty_table_and_bad_shape(spark):
    assert s.deduplicate(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        Shape(k=3, m=4)


def test_sql_twin(spark, tmp_path):
    passage = prose(5, 60, 10**6)
    rows = [(1, prose(1, 90) + "\n" + passage), (2, passage + " " + prose(2, 70)), (3, None), (4, ""), (5, passage + "\t" + passage)]
    path = str(tmp_path / "documents.parquet")
    documents(spark, rows).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    import hashlib

    got = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in s.deduplicate(spark.read.parquet(path)).collect()]
    assert sorted(got) == sorted(con.sql(s.ORACLE).fetchall())
