"""Near-duplicate groups, pairs without a distinct, comparison in blocks, components, joins with hot keys."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from test_lsh import MEMBERS, brute_near, brute_pairs
from tillmark.functions import hashing as H
from tillmark.operators import blocks, lsh, similarity as sim
from tillmark.operators.components import components
from tillmark.operators.skew import join_unique
from tillmark.plans import notices as near


def notices_of(spark, texts):
    return spark.createDataFrame(list(texts.items()), "notice_id bigint, body string")


def flood(ids, links):
    label = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("block", [256, 5])
def test_groups_equal_brute_force(spark, block):
    rng = random.Random(3)
    base = prose(rng, 80)
    texts = {i: prose(rng, 60) for i in range(15)}
    texts |= {20 + i: base + " " + prose(rng, i % 6) for i in range(25)} | {60 + i: base for i in range(6)}
    texts |= {80: "", 81: "", 82: "ab", 83: None}
    want = brute_near({i: t for i, t in texts.items() if t is not None}, 0.8)
    found, forest = near.near_groups(notices_of(spark, texts), 0.8, block=block)
    got = {r.notice_id: r for r in found.collect()}
    label = flood([i for i in texts], want)
    known = {i for i, t in texts.items() if t is not None}
    # What shares no bucket is no candidate: here all near pairs do but for a few at the threshold.
    shared = {tuple(r) for r in lsh.block_pairs(lsh.buckets_of(near.staged_bands(notices_of(spark, texts)))).collect()}
    links = [p for p in want if p in shared]
    assert len(links) > 200
    label = flood(list(texts), links)
    assert set(got) >= known
    assert {i: got[i].group_id for i in known} == {i: label[i] for i in known}
    assert {i: got[i].links for i in known} == {i: sum(i in p for p in links) for i in known}
    heads = {r.head for r in got.values()}
    edges = {(r.notice_id_a, r.notice_id_b): r.jaccard for r in forest.collect()}
    assert all(want[min(p), max(p)] == s for p, s in edges.items()) and {x for p in edges for x in p} <= heads
    tree = flood(list(heads), edges)
    assert {i: tree[got[i].head] for i in known} == {i: tree[got[label[i]].head] for i in known}


def test_two_thousand_near_copies_give_linear_rows(spark):
    rng = random.Random(4)
    base = prose(rng, 60)
    texts = {i: f"{base} {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'ef'[i // 1000]}" for i in range(2000)}
    found, forest = near.near_groups(notices_of(spark, texts), 0.8)
    got = found.collect()
    assert len(got) == 2000 and len({r.group_id for r in got}) == 1 and len({r.head for r in got}) == 2000
    assert min(r.links for r in got) > 1000
    edges = forest.count()
    assert 1999 <= edges <= 2 * 2000


def test_first_band_makes_each_pair_once_without_a_shuffle(spark):
    keys = {i: [f"{(i + b) % 3:032x}" if b < 2 else f"{i % 5:032x}" for b in range(4)] for i in range(60)}
    banded = spark.createDataFrame(list(keys.items()), "notice_id bigint, bands array<string>")
    want = {p for p in itertools.combinations(keys, 2) if any(x == y for x, y in zip(*[keys[i] for i in p]))}
    for block in (256, 7):
        pairs = lsh.block_pairs(lsh.buckets_with_prior(banded), block)
        got = rows(pairs)
        assert len(got) == len(set(got)) and set(got) == want
    plan = plan_of(pairs)
    assert "Exchange" not in plan[: plan.index("Join")]


def test_one_of_the_buckets_with_the_same_members_is_kept(spark):
    data = [(b, h, i) for (b, h), ids in MEMBERS.items() for i in ids] + [(7, "two once more", 2), (7, "two once more", 3)]
    buckets = spark.createDataFrame(data, "band_id int, bucket_hash string, notice_id bigint")
    kept = {(r.band_id, r.bucket_hash): r.size for r in lsh.kept_buckets(buckets).collect()}
    assert kept == {k: len(v) for k, v in MEMBERS.items() if len(v) > 1 and k != (1, "again")}
    assert brute_pairs({k: MEMBERS[k] for k in kept}) == brute_pairs(MEMBERS)


def test_scores_in_blocks(spark):
    rng = random.Random(6)
    texts = {i: prose(rng, 40) for i in range(40)} | {100: "", 101: None, 102: "ab", 103: "abc"}
    texts |= {200 + i: texts[i] + " more" for i in range(20)}
    pairs = [(i, 200 + i, "near") for i in range(20)] + [(0, i, "hub") for i in texts if i] + [(100, 101, "empty"), (103, 999, "unknown")]
    df = spark.createDataFrame(pairs, "notice_id_a bigint, notice_id_b bigint, label string")
    values = notices_of(spark, texts).select("notice_id", F.lower("body").alias("body"), F.substring(F.lower("body"), 1, 30).alias("head"))
    plain = {r.notice_id: (set(r.g), set(r.h)) for r in values.select("notice_id", H.gram_codes(F.col("body")).alias("g"), H.gram_codes(F.col("head")).alias("h")).collect()}
    want = set()
    for a, b, label in pairs:
        if b != 999:
            for n, name in enumerate(("body", "head")):
                x, y = plain[a][n], plain[b][n]
                want.add((a, b, label, name, len(x & y) / len(x | y) if x | y else 0.0))
    for block in (1024, 4):
        got = blocks.score_in_blocks(df, values, ["body", "head"], block=block)
        assert set(map(tuple, got.collect())) == want and got.count() == len(want)


def test_groups_of_squares_grow_with_the_pairs(spark):
    """A hundred blocks of texts make ten thousand squares, but forty pairs make four groups."""
    texts = notices_of(spark, {i: f"text number {i} of many" for i in range(1000)})
    pairs = spark.createDataFrame([(i, 999 - 7 * i) for i in range(40)], "notice_id_a bigint, notice_id_b bigint")
    scored = blocks.score_in_blocks(pairs, texts, ["body"], block=10)
    assert ", 42), 4) as int) AS _row" in plan_of(scored) or ", 42), 4) AS _row" in plan_of(scored)
    assert scored.count() == 40


def test_no_exchange_carries_a_set_per_pair(spark):
    """With broadcast off, the pairs' own exchange carries ids, and texts go by id and square."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = spark.createDataFrame([(1, 2, "same")], "notice_id_a bigint, notice_id_b bigint, label string")
        scored = blocks.score_in_blocks(pairs, notices_of(spark, {1: "some text", 2: "some texts"}), ["body"])
        plan = plan_of(scored)
        assert "array" not in plan and "grams" not in plan
        asked = next(part for part in plan.split("Exchange hashpartitioning(") if part.startswith("_row"))
        assert "body" not in asked.split("Sort [_to_row")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_components(spark):
    rng = random.Random(8)
    chain = [(i + 1, i) for i in range(1000, 1130)]
    star = [(5, i) for i in range(2000, 2400)]
    some = [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(70)]
    edges = chain + star + some + [(5, 5), (5, 2000)]
    df = spark.createDataFrame(edges, "x bigint, y bigint")
    want = flood([i for p in edges if p[0] != p[1] for i in p], [p for p in edges if p[0] != p[1]])
    assert {r.node: r.label for r in components(df, "x", "y").collect()} == want
    assert components(df.limit(0), "x", "y").collect() == []


def test_join_unique_with_a_hot_and_a_null_key(spark):
    data = [(i, None if i % 3 == 0 else 1 if i % 3 == 1 else i) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, k int")
    found = spark.createDataFrame([(None, "none"), (1, "hot"), (5, "five"), (7000, "unused")], "k int, name string")
    names = {None: "none", 1: "hot", 5: "five"}
    got = {(r.id, r.k, r.name) for r in join_unique(df, found, ["k"]).collect()}
    assert got == {(i, k, names.get(k)) for i, k in data}


def test_sim_forms_agree_with_blocks(spark):
    rng = random.Random(9)
    texts = {i: prose(rng, 30) for i in range(12)}
    df = notices_of(spark, texts)
    pairs = spark.createDataFrame([(i, j) for i, j in itertools.combinations(range(12), 2)], "notice_id_a bigint, notice_id_b bigint")
    exact = set(rows(sim.jaccard_pairs(pairs, sim.gram_sets(df))))
    values = df.select("notice_id", F.lower("body").alias("body")).withColumn("signature", H.signature(F.col("body"), 64))
    scored = blocks.score_in_blocks(pairs, values, ["body"], "signature")
    assert set(rows(scored.select("notice_id_a", "notice_id_b", "jaccard"))) == exact
    assert set(rows(scored.select("notice_id_a", "notice_id_b", "estimate"))) == set(rows(sim.minhash_similarity(pairs, sim.signatures(df, 64))))


def test_packed_sets_come_back(spark):
    rng = random.Random(10)
    df = notices_of(spark, {i: prose(rng, 5 * i) for i in range(8)} | {90: "", 91: "ab", 92: None, 93: "abc", 94: "\U0010ffff\U0010fffe\U0010ffff ä€"})
    unpack = H.set_unpacker()
    for r in df.select(H.gram_codes(F.col("body")).alias("g"), H.gram_packed(F.col("body")).alias("p")).collect():
        assert unpack(r.p).tolist() == r.g


def test_shared_counts_equal_plain_sets():
    """Trigrams of many members by matrix, of few by their holders: any rows against any columns."""
    import numpy as np

    rng = random.Random(11)
    sets = [sorted(set(rng.choices(range(40), k=30)) | set(rng.choices(range(100, 2000), k=rng.randrange(60)))) for _ in range(90)] + [[], [7]]
    shared = blocks._shared_counter()(np.array([len(s) for s in sets]), np.array([c for s in sets for c in s], np.int64))
    for low, high, left, right in ((0, 92, 0, 92), (5, 9, 40, 92), (91, 92, 0, 3)):
        got = shared(low, high, left, right)
        assert all(got[i - low, j - left] == len(set(sets[i]) & set(sets[j])) for i in range(low, high) for j in range(left, right) if i != j)


def test_all_pairs_come_out_of_the_squares_without_a_text_per_pair(spark):
    """Pairs of heads equal brute force, and neither texts nor candidates are written or shuffled for them."""
    rng = random.Random(12)
    base = prose(rng, 80)
    texts = {i: base + " " + prose(rng, i % 7) for i in range(45)} | {50 + i: prose(rng, 40) for i in range(10)} | {70: base, 71: base, 72: "", 73: None}
    df = notices_of(spark, texts)
    want = brute_near({i: t for i, t in texts.items() if t is not None}, 0.8)
    shared = {tuple(r) for r in lsh.block_pairs(lsh.buckets_of(near.staged_bands(df))).collect()}
    found = near.near_duplicates(df, 0.8)
    got = found.collect()
    heads = {r.notice_id_b: r.notice_id_a for r in got if r.kind == "member"}
    kept = {p: s for p, s in want.items() if p in shared and not set(p) & set(heads)}
    assert len(kept) > 300 and heads[71] == 70
    assert {(r.notice_id_a, r.notice_id_b): r.jaccard for r in got if r.kind == "pair"} == kept
    assert len(got) == len(kept) + len(heads)
    plan = plan_of(found)
    assert "body" not in plan and "candidates" not in plan
    squares = near.compared(*near.folded(df, "mask_then_strip", (), None)[1:], block=6)
    assert {(r.notice_id_a, r.notice_id_b): r.jaccard for r in blocks.near_in_squares(squares, 0.8, listed=True).collect()} == kept
