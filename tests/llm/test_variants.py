import random
import zlib
from collections import Counter

import pytest
import regex
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from support import documents, odd_rows

from tillmark.llm import variants as v


def apart(a, b):
    """Whether exactly one edit leads from one word to the other, by the whole matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        left, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            left, row[j + 1] = row[j + 1], min(left + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1] == 1


def grouped(counts, ratio=5):
    out, forms = [], {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if apart(w, x))
        if near and -near[0][0] >= ratio * n:
            forms[w] = near[0][1]
        out.append((w, n, len(near)))
    rows = []
    for w, n, near in out:
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, near, counts[forms[w]] if w in forms else None))
    return sorted(rows)


def brute_counts(rows, shortest=6, least=5, every=199):
    total = Counter()
    for i, text in rows:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= shortest and n >= least}


def texts(seed=5, n=150):
    """Words with slips of the pen of all kinds, in letters within and beyond ASCII."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeÀéßÿ") for _ in range(rng.randrange(6, 14))) for _ in range(30)]
    out = []
    for i in range(n):
        words = []
        for _ in range(80):
            w = rng.choice(base[: rng.choice((3, 30))])
            if rng.random() < 0.3:
                at, c = rng.randrange(len(w)), rng.choice("abé")
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]))
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice((" ", "1", "×’", "東")).join(words)))
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_equals_brute_force(spark):
    rows = texts() + odd_rows() + [(None, "Straße straße STRASSE " * 9), (901, "unbroken" * 4000 + " " + ("unbroken" * 4000)[:-1])] * 5
    counts = brute_counts(rows, every=7)
    longest = max(counts, key=len)
    assert len(longest) > 30000
    found = got(v.variants(documents(spark, rows, clashes=True), every=7))
    assert [r[0] for r in found] == sorted(counts) and {r[0]: r[3] for r in found} == counts
    short = {w: n for w, n in counts.items() if len(w) < 100}
    assert [r for r in found if len(r[0]) < 100] == grouped(short) and len(short) > 200
    assert sum(r[1] is not None for r in found) > 50 and any(r[2] != (r[1] or r[0]) for r in found)


@pytest.mark.parametrize("limit", [2, 7, 1000])
def test_groups_cut_again_lose_nothing(spark, limit):
    """A third of all words share long halves; groups are cut down to single positions."""
    rng = random.Random(limit)
    words = {"prefixes" + "".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(60)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) + "suffixes" for _ in range(60)}
    words |= {"".join(rng.choice("abc") for _ in range(6)) for _ in range(120)}
    counts = {w: rng.choice((5, 6, 40, 400, 4000)) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(v.group_variants(df, limit=limit)) == grouped(counts)
    sizes = v.groups(df, limit).groupBy("group").agg(F.count("*").alias("n"), F.max(F.col("high") - F.col("low")).alias("width"))
    assert sizes.where((F.col("n") > limit) & (F.col("width") > 1)).isEmpty()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abÿ", min_size=1, max_size=7), min_size=1, max_size=30, unique=True))
def test_scan_finds_what_the_matrix_finds(words):
    words.sort()
    shared = [0] + [v.shared_prefix(a, b) for a, b in zip(words, words[1:], strict=False)]
    for i in range(len(words)):
        want = [(k, v.shared_prefix(words[i], words[k])) for k in range(i + 1, len(words)) if apart(words[i], words[k])]
        assert list(v.scan(words, shared, i)) == want


def test_ties_chains_and_empty_tables(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaabb": 125, "aaabbb": 700, "zzzzzz": 9}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(v.group_variants(df)) == grouped(counts)
    rows = {r.word: r for r in v.group_variants(df).collect()}
    assert rows["aaaaaa"].form == "aaaaab" and rows["aaaaaa"].root == "aaabbb" and rows["zzzzzz"].root == "zzzzzz"
    assert v.variants(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        v.group_variants(df, ratio=1)


def test_registered_query(spark, tmp_path):
    rows = texts(8, 60)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert got(v.op13_sorted_scan(spark, str(tmp_path))) == grouped(brute_counts(rows))
