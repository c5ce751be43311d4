import hashlib
import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tillmark.functions import hashing as H
from tillmark.operators import similarity as sim

MODULUS = 2147483647


def plain_base(gram):
    return int(hashlib.md5(gram.encode()).hexdigest()[:8], 16)


def plain_signature(grams, k):
    return [min(((i + 1) * plain_base(g) + 137 * i) % MODULUS for g in grams) if grams else MODULUS for i in range(k)]


def windows(text):
    low = text.lower()
    return {low[i : i + 3] for i in range(len(low) - 2)}


@pytest.fixture(scope="module")
def notices(spark):
    rng = random.Random(7)
    texts = ["", "a", "ab", "abc", "aaaaaa", "İstanbul 😀😃 ÄÖ", "line\nbreak\r\n", "x" * 5000]
    texts += ["".join(rng.choices("abcdeé😀 \nXYZ", k=n)) for n in (50, 500, 5000)]
    return spark.createDataFrame(list(enumerate(texts)), "notice_id bigint, body string")


def test_signature_equals_brute_force(notices):
    got = {r.notice_id: r.signature for r in sim.signatures(notices, 64).collect()}
    for row in notices.collect():
        assert got[row.notice_id] == plain_signature(windows(row.body), 64)


def test_codes_equal_built_in_trigrams(notices):
    strings = {r.notice_id: r.grams for r in sim.trigrams(notices).collect()}
    for row in sim.gram_sets(notices).collect():
        expected = sorted(ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in strings[row.notice_id])
        assert row.grams == expected


def test_signature_equals_aggregate_form(notices):
    """The same minima as plain SQL aggregates over exploded trigrams."""
    k = 16
    tokens = sim.trigrams(notices).select("notice_id", F.explode(H.base_hashes(F.col("grams"))).alias("x"))
    slots = [F.min((F.col("x") * (i + 1) + 137 * i) % MODULUS).cast("int") for i in range(k)]
    twin = tokens.groupBy("notice_id").agg(F.array(*slots).alias("signature"))
    got = {r.notice_id: r.signature for r in sim.signatures(notices, k).collect()}
    twins = {r.notice_id: r.signature for r in twin.collect()}
    assert twins == {i: s for i, s in got.items() if i in twins}
    assert set(got) - set(twins) == {0, 1, 2}


def test_many_texts_in_one_batch(spark):
    """More trigrams than are worked on together."""
    words = F.transform(F.sequence(F.lit(1), (F.col("id") % 5) * 200 + 1), lambda i: F.concat(F.col("id"), F.lit("-"), i))
    data = spark.range(300).select(F.col("id").alias("notice_id"), F.array_join(words, " ").alias("body")).coalesce(1)
    got = {r.notice_id: r.signature for r in sim.signatures(data, 8).collect()}
    for row in data.collect():
        assert got[row.notice_id] == plain_signature(windows(row.body), 8)


def test_null_and_no_texts(spark):
    none = spark.createDataFrame([(1, None)], "notice_id bigint, body string")
    assert none.select(H.gram_codes(F.col("body"))).first()[0] == []
    assert sim.signatures(none, 4).first().signature == [MODULUS] * 4
    assert sim.signatures(none.where("false"), 4).collect() == []


@pytest.mark.parametrize("bands, rows_", [(4, 4), (8, 2), (16, 1), (1, 16)])
def test_band_keys_equal_printed_tuples(notices, bands, rows_):
    sigs = sim.signatures(notices, 16)
    for row in sigs.select("notice_id", "signature", H.band_keys(F.col("signature"), bands, rows_).alias("keys")).collect():
        slots = [float("inf") if v == MODULUS else v for v in row.signature]
        expected = [hashlib.md5(str(tuple(slots[b * rows_ : (b + 1) * rows_])).encode()).hexdigest() for b in range(bands)]
        assert row["keys"] == expected


def test_empty_texts_disagree_between_exact_and_estimate(spark):
    notices = spark.createDataFrame([(1, ""), (2, "ab"), (3, "abcd")], "notice_id bigint, body string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3, 3)], "notice_id_a bigint, notice_id_b bigint")
    grams = sim.trigrams(notices)
    exact = {tuple(r)[:2]: r.jaccard for r in sim.jaccard_pairs(pairs, grams).collect()}
    estimate = {tuple(r)[:2]: r.estimate for r in sim.minhash_similarity(pairs, sim.signatures(notices, 32)).collect()}
    assert exact == {(1, 2): 0.0, (1, 3): 0.0, (3, 3): 1.0}
    assert estimate == {(1, 2): 1.0, (1, 3): 0.0, (3, 3): 1.0}


def test_error_shrinks_with_k(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]
    texts = [(i, " ".join(rng.choices(words, k=120))) for i in range(20)]
    notices = spark.createDataFrame(texts, "notice_id bigint, body string")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(19)], "notice_id_a bigint, notice_id_b bigint")
    means = []
    for k in (16, 400):
        sets = sim.gram_sets(notices).join(sim.signatures(notices, k), "notice_id")
        scored = sim.minhash_error(sim.score_pairs(pairs, sets), k).collect()
        assert all(0.0 <= r.jaccard <= 1.0 and r.within_bound == (r.error_pct <= 100 / k**0.5) for r in scored)
        means.append(sum(r.error_pct for r in scored) / len(scored))
    assert means[1] < means[0] and means[1] < 5.0


def test_similarity_is_symmetric_and_codes_equal_strings(spark):
    notices = spark.createDataFrame([(1, "the quick brown fox"), (2, "the quick red fox"), (3, "other")], "notice_id bigint, body string")
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 3)], "notice_id_a bigint, notice_id_b bigint")
    by_string = sorted(map(tuple, sim.jaccard_pairs(pairs, sim.trigrams(notices)).collect()))
    by_code = sorted(map(tuple, sim.jaccard_pairs(pairs, sim.gram_sets(notices)).collect()))
    assert by_string == by_code
    assert by_string[0][2] == by_string[2][2]


def test_batches_are_worked_on_in_bounded_pieces(spark, notices, monkeypatch):
    """Whatever a batch holds, a piece of it is bounded, and no result depends on the cut."""
    seen = []

    def lengths(piece):
        seen.append(pc.sum(pc.binary_length(piece)).as_py() or 0)
        return pc.binary_length(piece)

    batch = pa.array(["abc" * 30, None, "", "x" * 500, *["word " * n for n in range(40)]])
    monkeypatch.setattr(H, "PIECE", 100)
    monkeypatch.setattr(H, "KNOWN", 50)
    assert H.piecewise(lengths)(batch).equals(pc.binary_length(batch))
    longest = pc.max(pc.binary_length(batch)).as_py()
    assert len(seen) > 5 and max(seen) == longest and sum(n > 100 for n in seen) == pc.sum(pc.greater(pc.binary_length(batch), 100)).as_py()

    together = notices.coalesce(1)
    signed = {r.notice_id: r.signature for r in sim.signatures(together, 16).collect()}
    totals = {r.notice_id: (r.t.trigrams, r.t.hash_sum) for r in together.select("notice_id", H.gram_totals(F.col("body")).alias("t")).collect()}
    for row in notices.collect():
        grams = windows(row.body)
        assert signed[row.notice_id] == plain_signature(grams, 16)
        assert totals[row.notice_id] == (len(grams), sum(map(plain_base, grams)))
    for row in sim.set_table(together).collect():
        assert row.size == len(row.grams) == totals[row.notice_id][0]
