import itertools
import math
from collections import Counter, defaultdict

import pytest

from conftest import plan_of, rows
from tillmark.operators import lsh, similarity as sim
from tillmark.plans import notices as near

BANDS = 3


def table(spark, members):
    """``members``: {(band, bucket): ids}"""
    data = [(band, bucket, i) for (band, bucket), ids in members.items() for i in ids]
    return spark.createDataFrame(data, "band_id int, bucket_hash string, notice_id bigint")


MEMBERS = {
    (0, "single"): [1],
    (0, "two"): [2, 3],
    (0, "limit"): [10, 11, 12, 13],
    (0, "over"): [20, 21, 22, 23, 24],
    (1, "again"): [3, 2],
    (1, "limit"): [13, 11],
    (2, "hot"): list(range(100, 400)),
}
M = 4


def brute_pairs(members, limit=None):
    found = set()
    for ids in members.values():
        if limit is None or len(ids) <= limit:
            found |= set(itertools.combinations(sorted(ids), 2))
    return found


def test_pairs_of_sparse_buckets_once(spark):
    got = rows(lsh.candidate_pairs(table(spark, MEMBERS), M))
    assert len(got) == len(set(got))
    assert set(got) == brute_pairs(MEMBERS, M)


def test_pruned_is_subset_of_unpruned(spark):
    buckets = table(spark, MEMBERS)
    small, large = set(rows(lsh.candidate_pairs(buckets, M))), set(rows(lsh.candidate_pairs(buckets, 999)))
    assert small < large == brute_pairs(MEMBERS)


def test_candidates_lose_nothing(spark):
    got = lsh.lsh_candidates(table(spark, MEMBERS), M).collect()
    pairs = {(r.notice_id_a, r.notice_id_b) for r in got if r.kind == "pair"}
    dense = defaultdict(list)
    for r in got:
        if r.kind == "member":
            dense[(r.band_id, r.bucket_hash)].append(r.notice_id_a)
    assert {k: sorted(v) for k, v in dense.items()} == {k: v for k, v in MEMBERS.items() if len(v) > M}
    assert pairs | brute_pairs(dense) == brute_pairs(MEMBERS)


def test_limit_beyond_the_group_limit(spark):
    members = MEMBERS | {(5, "wide"): list(range(1000, 2200))}
    got = {tuple(r)[:2] for r in lsh.prune_dense_buckets(table(spark, members), 1100).collect()}
    assert got == {k for k, v in members.items() if 1 < len(v) <= 1100}
    with pytest.raises(ValueError, match="max_bucket"):
        lsh.candidate_pairs(table(spark, MEMBERS), 0)


@pytest.mark.parametrize("block", [256, 7, 1])
def test_block_pairs_lose_nothing(spark, block):
    got = rows(lsh.block_pairs(table(spark, {k: v[:40] for k, v in MEMBERS.items()}), block))
    assert len(got) == len(set(got))
    assert set(got) == brute_pairs({k: v[:40] for k, v in MEMBERS.items()})


def test_prune_keeps_colliding_bounded_buckets(spark):
    got = {tuple(r)[:2] for r in lsh.prune_dense_buckets(table(spark, MEMBERS), M).collect()}
    assert got == {k for k, v in MEMBERS.items() if 1 < len(v) <= M}


def test_volume_counts_without_listing(spark):
    got = {r.band_id: r for r in lsh.pair_volume(table(spark, MEMBERS), M).collect()}
    assert (got[0].colliding_buckets, got[0].dense_buckets, got[0].pairs, got[0].pairs_after_pruning) == (3, 1, 17, 7)
    assert (got[2].dense_buckets, got[2].pairs, got[2].pairs_after_pruning) == (1, 300 * 299 // 2, 0)


def test_histogram(spark):
    got = {(r.band_id, r.size): r.buckets for r in lsh.bucket_histogram(table(spark, MEMBERS)).collect()}
    assert got == Counter((band, len(ids)) for (band, _), ids in MEMBERS.items())


def test_hot_bucket_is_cut_before_the_shuffle(spark):
    plan = plan_of(lsh.candidate_pairs(table(spark, MEMBERS), M))
    before_shuffle = plan[plan.index("Exchange hashpartitioning(band_id") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert plan.count("Exchange hashpartitioning(band_id") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_lookup(spark):
    buckets = table(spark, MEMBERS)
    assert rows(lsh.bucket_lookup(buckets, 0, "two")) == [(2,), (3,)]
    queries = table(spark, {(0, "two"): [2], (1, "again"): [2], (2, "hot"): [2], (0, "single"): [900]})
    got = set(rows(lsh.lookup_notices(queries, buckets, M)))
    assert got == {(2, 3, 2), (2, None, 1), (900, 1, 1)}
    whole = set(rows(lsh.lookup_notices(queries, buckets)))
    assert whole == {(2, 3, 2), (900, 1, 1)} | {(2, i, 1) for i in range(100, 400)}


def test_lookup_adds_up_bounded_hits_a_task(spark, monkeypatch):
    """Hits are counted first, dealt by pair into enough tasks, and added up nowhere else."""
    monkeypatch.setattr(lsh, "HITS", 20)
    buckets = table(spark, MEMBERS)
    queries = table(spark, {(0, "two"): [2], (1, "again"): [2], (2, "hot"): [2], (0, "single"): [900]})
    hits = sum(len(MEMBERS[k]) for k in ((0, "two"), (1, "again"), (2, "hot"), (0, "single")))
    found = lsh.lookup_notices(queries, buckets)
    plan = plan_of(found)
    assert set(rows(found)) == {(2, 3, 2), (900, 1, 1)} | {(2, i, 1) for i in range(100, 400)}
    dealt = plan.index("Exchange hashpartitioning(query_id")
    assert f", {-(-hits // 20)}), REPARTITION_BY_NUM" in plan[dealt:].split("\n")[0] and "HashAggregate" not in plan[dealt:]


def banded(spark, keys):
    return spark.createDataFrame([(i, list(k)) for i, k in keys.items()], "notice_id bigint, bands array<string>")


KEYS = {1: "abc", 2: "abd", 3: "xyz", 4: "xqq", 5: "xrr", 6: "xst", 7: "uvw"}
LABELS = [(1, 2, "same"), (3, 4, "same"), (1, 7, "different"), (6, 7, "same")]


def test_recall_before_and_after(spark):
    pairs = spark.createDataFrame(LABELS, "notice_id_a bigint, notice_id_b bigint, label string")
    hits = lsh.labelled_hits(pairs, banded(spark, KEYS), 3)
    got = {(r.notice_id_a, r.notice_id_b): (r.shared_buckets, r.kept_buckets) for r in hits.collect()}
    # Bucket (0, "x") holds four notices and is dense at three.
    assert got == {(1, 2): (2, 2), (3, 4): (1, 0), (1, 7): (0, 0), (6, 7): (0, 0)}
    recall = lsh.pruning_recall(hits).first()
    assert (recall.same_pairs, recall.found_before, recall.found_after) == (3, 2, 1)
    assert recall.recall_loss_pct == pytest.approx(100 / 3)


def test_recall_without_same_pairs_is_null(spark):
    pairs = spark.createDataFrame([(1, 7, "different")], "notice_id_a bigint, notice_id_b bigint, label string")
    assert lsh.pruning_recall(lsh.labelled_hits(pairs, banded(spark, KEYS))).first().recall_before is None


def test_stats(spark):
    stats = lsh.lsh_stats(banded(spark, KEYS), 3).first()
    assert (stats.notices, stats.possible_pairs, stats.candidate_pairs, stats.dense_buckets) == (7, 21, 7, 1)
    assert stats.reduction_pct == pytest.approx(100 * (1 - 7 / 21))
    assert lsh.lsh_stats(banded(spark, {1: "abc"})).first().reduction_pct is None


def test_stats_count_each_pair_once(spark):
    """60 equal notices share every bucket, others some: the share stays between 0 and 100."""
    keys = {i: "abcd" for i in range(60)} | {100 + i: "ab" + "xy"[i % 2] + str(i) for i in range(40)}
    stats = lsh.lsh_stats(banded(spark, keys)).first()
    want = sum(any(x == y for x, y in zip(keys[i], keys[j])) for i, j in itertools.combinations(keys, 2))
    assert stats.candidate_pairs == want and stats.dense_buckets == 4
    assert stats.reduction_pct == pytest.approx(100 * (1 - want / stats.possible_pairs))


def test_empty_signatures_collide_or_are_dropped(spark):
    notices = spark.createDataFrame([(1, ""), (2, "a"), (3, "some text")], "notice_id bigint, body string")
    sigs = sim.signatures(notices, 400)
    kept = lsh.band_table(sigs)
    assert rows(lsh.candidate_pairs(lsh.buckets_of(kept))) == [(1, 2)]
    dropped = lsh.band_table(sigs, empty="drop")
    assert [r.notice_id for r in dropped.collect()] == [3]


def test_more_bands_give_more_candidates(spark):
    base = "the committee invites sealed tenders for the supply of pipes and fittings to the town "
    notices = spark.createDataFrame([(i, base + str(i) * (i % 4) + "x" * i) for i in range(30)], "notice_id bigint, body string")
    sigs = sim.signatures(notices, 400).cache()
    few = set(rows(lsh.candidate_pairs(lsh.buckets_of(lsh.band_table(sigs, 10, 8)))))
    many = set(rows(lsh.candidate_pairs(lsh.buckets_of(lsh.band_table(sigs, 50, 8)))))
    assert few <= many and len(many) > 0


def test_s_curve(spark):
    curve = lsh.s_curve(spark).orderBy("similarity").collect()
    assert len(curve) == 300 and curve[0].probability == 0.0 and curve[-1].probability == 1.0
    assert all(a.probability <= b.probability for a, b in zip(curve, curve[1:]))
    assert lsh.threshold(20, 20) == pytest.approx(0.861, abs=1e-3)
    assert lsh.threshold(50, 8) == pytest.approx(0.613, abs=1e-3)
    s = curve[200].similarity
    assert math.isclose(curve[200].probability, 1 - (1 - s**20) ** 20)


def brute_near(texts, threshold):
    """All pairs of ids whose trigram sets reach the threshold, from the texts alone."""
    import re

    def grams(text):
        low = re.sub(r"\d+", "<NUM>", text).lower()
        return frozenset(low[i : i + 3] for i in range(len(low) - 2))

    sets = {i: grams(t) for i, t in texts.items()}
    out = {}
    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        score = len(x & y) / len(x | y) if x | y else 0.0
        if score >= threshold:
            out[a, b] = score
    return out


def expanded(found):
    """Pairs of notices that follow from pair and member rows."""
    groups = defaultdict(set)
    for r in found:
        if r.kind == "member":
            groups[r.notice_id_a].add(r.notice_id_b)
    out = {}
    for head, rest in groups.items():
        out |= {p: 1.0 for p in itertools.combinations(sorted({head, *rest}), 2)}
    for r in found:
        if r.kind == "pair":
            for a in {r.notice_id_a, *groups[r.notice_id_a]}:
                for b in {r.notice_id_b, *groups[r.notice_id_b]}:
                    out[min(a, b), max(a, b)] = r.jaccard
    return out


def test_pipeline_equals_brute_force(spark):
    base = "notice of tender for the construction of a bridge over the river near the old mill "
    texts = {i: base + ("again " * (i % 3)) + ("appendix %d" % (i // 4)) for i in range(24)}
    texts[50], texts[51], texts[52], texts[53] = "something entirely different in this text", "ab", "", "ab"
    notices = spark.createDataFrame(list(texts.items()), "notice_id bigint, body string")
    assert expanded(near.near_duplicates(notices, 0.9).collect()) == brute_near(texts, 0.9)


@pytest.mark.parametrize("copies", [60, 500])
def test_large_groups_of_copies_are_complete(spark, copies):
    words = "the municipal board invites sealed bids for repair of drains and culverts in ward"
    texts = {i: words for i in range(copies)} | {1000 + i: words + " " + "abcdefgh"[i % 8] * (i + 1) for i in range(70)}
    notices = spark.createDataFrame(list(texts.items()), "notice_id bigint, body string")
    found = near.near_duplicates(notices, 0.95).collect()
    members = {r.notice_id_b for r in found if r.kind == "member" and r.notice_id_a == 0}
    assert members == set(range(1, copies))
    want, got = brute_near(texts, 0.95), expanded(found)
    assert set(got.items()) <= set(want.items())
    assert {p for p, s in want.items() if s == 1.0} <= set(got)
    assert len(found) < copies + 70 * 70


def test_repeated_ids_never_pair_with_themselves(spark):
    notices = spark.createDataFrame([("x", "the same text twice"), ("x", "the same text twice"), ("y", "the same text twice")], "notice_id string, body string")
    assert rows(near.near_duplicates(notices, 0.8)) == [("member", "x", "y", 1.0)]
    versions = spark.createDataFrame([("x", "an old text", "2024-01-01"), ("x", "a new text here", "2024-02-01"), ("y", "an old text", None)], "notice_id string, body string, published_at string")
    assert rows(near.near_duplicates(versions, 0.8, latest="published_at")) == []


def test_asked_for_limit_still_prunes(spark):
    words = "tender for supply of pipes and fittings to the town "
    notices = spark.createDataFrame([(i, words + "z" * (i + 3)) for i in range(12)], "notice_id bigint, body string")
    assert near.near_duplicates(notices, 0.8, max_bucket=3).where("kind = 'pair'").count() < near.near_duplicates(notices, 0.8).where("kind = 'pair'").count() + 1


def test_unique_notices(spark):
    notices = spark.createDataFrame([("n1", "old", 1), ("n1", "new", 2), ("n2", "only", 1)], "notice_id string, body string, version int")
    assert [(r[0], r[1]) for r in near.unique_notices(notices, "version").orderBy("notice_id").collect()] == [("n1", "new"), ("n2", "only")]


def test_bucket_table_prunes_bands(spark):
    from tillmark.sources.tables import write_buckets

    stored = write_buckets(table(spark, MEMBERS), "lsh_buckets_test", files=2)
    looked = lsh.bucket_lookup(stored, 0, "two")
    plan = plan_of(looked)
    assert "PartitionFilters: [isnotnull(band_id" in plan and "EqualTo(bucket_hash,two)" in plan
    assert rows(looked) == [(2,), (3,)]


def test_portal_volume_first_of_class_and_peek(spark):
    notices = spark.createDataFrame([(1, "x" * 600, "P2"), (2, "short", "P1"), (3, "other", "P2")], "notice_id bigint, body string, portal_id string")
    assert rows(sim.portal_volume(notices, k=1)) == [("P2", 2)]
    pairs = spark.createDataFrame([(2, 3, "same"), (1, 2, "same"), (1, 3, "different")], "notice_id_a bigint, notice_id_b bigint, label string")
    first = sim.first_of_class(pairs)
    assert rows(first) == [(1, 2, "same"), (1, 3, "different")]
    assert rows(sim.peek(notices, first.where("label = 'same'"))) == [(1, 600, "x" * 500), (2, 5, "short")]


def test_evaluation_flags_inversion(spark):
    scores = spark.createDataFrame(
        [("raw", "same", 0.4), ("raw", "different", 0.5), ("clean", "same", 0.9), ("clean", "different", 0.1)],
        "strategy string, label string, jaccard double",
    )
    got = {r.strategy: r.inverted for r in sim.evaluate_metric(scores).collect()}
    assert got == {"raw": True, "clean": False}


def test_a_third_of_all_notices_are_copies(spark):
    """The copies stay whole, as one member row per band, and no pair of them is listed."""
    import random

    rng = random.Random(5)
    own = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=200))
    copy = own()
    texts = [(i, copy if i % 3 == 0 else own()) for i in range(90)]
    notices = spark.createDataFrame(texts, "notice_id bigint, body string")
    got = lsh.lsh_candidates(lsh.buckets_of(near.staged_bands(notices)), 10).collect()
    copies = {i for i, body in texts if body == copy}
    members = defaultdict(set)
    for r in got:
        if r.kind == "member":
            members[r.band_id].add(r.notice_id_a)
        else:
            # The first band's multipliers are small, so unrelated texts may meet there.
            assert not copies & {r.notice_id_a, r.notice_id_b}
    assert set(members) == set(range(20)) and all(ids == copies for ids in members.values())
    assert sum(r.kind == "member" for r in got) == 20 * len(copies)
