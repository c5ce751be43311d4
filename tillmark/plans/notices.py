"""Near-duplicate notices: texts to signatures, buckets, candidates and verified pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillmark.functions import hashing as H, text as X
from tillmark.operators import blocks, lsh, similarity as sim
from tillmark.operators.components import components
from tillmark.operators.dedup import dedup_latest
from tillmark.operators.skew import join_unique
from tillmark.staging import stage


def unique_notices(notices: DataFrame, latest: str | None = None) -> DataFrame:
    """One text per notice id: the one with the greatest ``latest``, by default the greatest body."""
    return dedup_latest(notices, [sim.ID], latest or sim.BODY)


def grams(
    notices: DataFrame, strategy: str = "mask_then_strip", phrases: Sequence[str] = X.PHRASES
) -> DataFrame:
    return sim.trigrams(sim.clean_text(notices, strategy, phrases))


def staged_bands(
    notices: DataFrame,
    strategy: str = "mask_then_strip",
    phrases: Sequence[str] = X.PHRASES,
    k: int = 400,
    bands: int = 20,
    empty: str = "sentinel",
) -> DataFrame:
    """Band keys of every notice, written once because several stages read them (an action).

    Up to here every notice is handled on its own: texts are never shuffled.
    """
    sigs = sim.signatures(sim.clean_text(notices, strategy, phrases), k)
    return stage(lsh.band_table(sigs, bands, k // bands, empty), "bands")


def lowered(notices: DataFrame, strategies: dict[str, str], phrases: Sequence[str] = X.PHRASES, span: int = 1400) -> DataFrame:
    """``notice_id`` and a lower-cased text for each column name of ``strategies``, cleaned by the strategy it names."""
    body = F.col(sim.BODY)
    return notices.select(sim.ID, *[F.lower(X.cleaner(s, phrases, span)(body)).alias(name) for name, s in strategies.items()])


def exact_scores(
    notices: DataFrame,
    pairs: DataFrame,
    strategy: str = "mask_then_strip",
    phrases: Sequence[str] = X.PHRASES,
) -> DataFrame:
    """Exact similarity of every pair, compared in blocks."""
    texts = lowered(notices, {strategy: strategy}, phrases)
    return blocks.score_in_blocks(pairs, texts, [strategy]).drop("strategy")


def estimate_errors(
    notices: DataFrame,
    pairs: DataFrame,
    strategy: str = "mask_then_strip",
    phrases: Sequence[str] = X.PHRASES,
    k: int = 400,
) -> DataFrame:
    """Exact similarity, estimate and error of every pair."""
    texts = lowered(notices, {strategy: strategy}, phrases).withColumn("signature", H.signature(F.col(strategy), k))
    scored = blocks.score_in_blocks(pairs, texts, [strategy], "signature").drop("strategy")
    return sim.minhash_error(scored, k)


def strategy_scores(
    notices: DataFrame,
    pairs: DataFrame,
    strategies: Sequence[str],
    phrases: Sequence[str] = X.PHRASES,
    span: int = 1400,
) -> DataFrame:
    """Exact similarity of every pair under every cleaning strategy."""
    return blocks.score_in_blocks(pairs, lowered(notices, {s: s for s in strategies}, phrases, span), strategies)


def folded(notices: DataFrame, strategy: str, phrases: Sequence[str], latest: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One text per id; their sizes, digests, bands and packed sets; and one head for each digest, with ``weight`` notices (an action)."""
    settled = unique_notices(notices, latest)
    body = F.col(sim.BODY)
    known = sim.clean_text(settled, strategy, phrases).select(
        sim.ID, H.gram_digest(body).alias("_d"), H.signature(body, 400).alias("signature"), H.gram_packed(body).alias("packed")
    )
    bands = H.band_keys(F.col("signature"), 20, 20).alias("bands")
    known = stage(known.select(sim.ID, "_d.size", "_d.digest", bands, "packed"), "bands")
    heads = known.where("size > 0").groupBy("digest").agg(F.min(sim.ID).alias("head"), F.count("*").alias("weight"))
    return settled, known, heads


def compared(known: DataFrame, heads: DataFrame, block: int = 4096) -> DataFrame:
    """The heads' packed sets, dealt into the squares of their buckets, for ``blocks.near_in_squares``.

    Narrow rows say which head goes to which squares; its set, weight and band keys join them once
    and move with it. ``prior`` has the keys of the bands before that of the square.
    """
    groups = known.join(heads.select(F.col("head").alias(sim.ID), "weight"), sim.ID)
    keys = F.transform("bands", lambda key: F.unhex(key))
    squares = lsh.squares_of(groups.select(sim.ID, "bands", "size"), block)
    told = squares.join(groups.select(sim.ID, "weight", "packed", keys.alias("_keys")), sim.ID)
    return told.withColumn("prior", F.slice("_keys", 1, F.col("band_id")))


def near_groups(
    notices: DataFrame,
    threshold: float = 0.8,
    strategy: str = "mask_then_strip",
    phrases: Sequence[str] = X.PHRASES,
    latest: str | None = None,
    block: int = 4096,
) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate groups without a list of pairs (an action).

    The first table has one row a notice: ``notice_id``, ``head`` (the smallest id with the same
    trigram set), ``group_id`` (the smallest id it is connected with by links) and ``links``, the
    number of other notices that share a bucket with it and reach the threshold. The second holds
    links that span the groups: ``notice_id_a, notice_id_b, jaccard`` between heads. Both stay
    linear in the notices however many near copies there are: pairs are compared where a bucket's
    blocks meet and only counted. Texts without trigrams are similar to none.
    """
    _, known, heads = folded(notices, strategy, phrases, latest)
    found = stage(blocks.near_in_squares(compared(known, heads, block), threshold), "near")
    forest = found.where(F.col(sim.PAIR[1]).isNotNull()).select(*sim.PAIR, "jaccard")
    label = components(forest, *sim.PAIR).select(F.col("node").alias("head"), F.col("label").alias("group_id"))
    links = found.where("links is not null").groupBy(F.col(sim.PAIR[0]).alias("head")).agg(F.sum("links").alias("linked"))
    told = stage(heads.join(label, "head", "left").join(links, "head", "left"), "heads")
    rows = join_unique(known.select(sim.ID, "digest"), told, ["digest"])
    return rows.select(
        sim.ID, F.coalesce("head", sim.ID).alias("head"), F.coalesce("group_id", "head", sim.ID).alias("group_id"),
        (F.coalesce("linked", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("links"),
    ), forest


def near_duplicates(
    notices: DataFrame,
    threshold: float = 0.8,
    strategy: str = "mask_then_strip",
    phrases: Sequence[str] = X.PHRASES,
    max_bucket: int | None = None,
    latest: str | None = None,
) -> DataFrame:
    """Near-duplicates as ``kind, notice_id_a, notice_id_b, jaccard`` (an action).

    One text per id is settled first.  Notices with the same trigram set fold into a group
    named by its smallest id: ``kind = 'member'`` rows list the others, similarity 1.0, linear
    in the group.  ``kind = 'pair'`` rows are all pairs of groups that share a bucket and reach
    the threshold; any pair of notices follows from the two.  They are compared where a bucket's
    blocks meet: no list of candidates is written, and a packed set moves once a square, not once a pair.
    Nothing is dropped unless the caller passes ``max_bucket``.  Texts without trigrams are similar to none.
    """
    settled, known, heads = folded(notices, strategy, phrases, latest)
    known = known.where("size > 0")
    members = known.join(heads, "digest").where(F.col(sim.ID) != F.col("head"))
    if max_bucket is None:
        verified = blocks.near_in_squares(compared(known, heads), threshold, listed=True)
    else:
        groups = known.join(heads.select(F.col("head").alias(sim.ID)), sim.ID, "left_semi")
        pairs = stage(lsh.candidate_pairs(lsh.buckets_of(groups), max_bucket), "candidates")
        verified = exact_scores(settled, pairs, strategy, phrases).where(F.col("jaccard") >= threshold)
    shown = members.select(F.lit("member").alias("kind"), F.col("head").alias(sim.PAIR[0]), F.col(sim.ID).alias(sim.PAIR[1]), F.lit(1.0).alias("jaccard"))
    return verified.select(F.lit("pair").alias("kind"), *sim.PAIR, "jaccard").union(shown)
