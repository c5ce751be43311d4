"""Exact and estimated similarity of labelled or candidate pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillmark.functions import hashing as H, text as X

ID, BODY = "notice_id", "body"
PAIR = ("notice_id_a", "notice_id_b")


def clean_text(notices: DataFrame, strategy: str, phrases: Sequence[str] = X.PHRASES,
               span: int = 1400) -> DataFrame:
    """Notices with the body cleaned by the named strategy."""
    return notices.withColumn(BODY, X.cleaner(strategy, phrases, span)(F.col(BODY)))


def trigrams(notices: DataFrame) -> DataFrame:
    """``notice_id, grams``."""
    return notices.select(ID, X.trigrams(F.col(BODY)).alias("grams"))


def gram_sets(notices: DataFrame) -> DataFrame:
    """``notice_id, grams`` with the trigrams as numbers, for exact comparison."""
    return notices.select(ID, H.gram_codes(F.col(BODY)).alias("grams"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two distinct arrays; 0.0 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared, F.size(a) + F.size(b) - shared), F.lit(0.0))


def members(notices: DataFrame, pairs: DataFrame) -> DataFrame:
    """Notices that occur in a pair."""
    ids = pairs.select(F.col(PAIR[0]).alias(ID)).union(pairs.select(PAIR[1])).distinct()
    return notices.join(ids, ID, "left_semi")


def attach(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs with every other column of ``values`` twice, suffixed ``_a`` and ``_b``."""
    for side, key in zip("ab", PAIR):
        renamed = values.select(
            F.col(ID).alias(key), *[F.col(c).alias(f"{c}_{side}") for c in values.columns if c != ID]
        )
        pairs = pairs.join(renamed, key)
    return pairs


def jaccard_pairs(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Pairs with their exact similarity.

    Where ``grams`` has ``size`` and ``digest`` (see ``set_table``), pairs of equal digests are
    settled by these alone: 1.0, or 0.0 for empty sets.  Only the sets of the others move.
    """
    score = jaccard(F.col("grams_a"), F.col("grams_b")).alias("jaccard")
    if "digest" not in grams.columns:
        return attach(pairs, grams.select(ID, "grams")).select(*pairs.columns, score)
    slim = attach(pairs, grams.select(ID, "size", "digest"))
    same = F.col("digest_a") == F.col("digest_b")
    equal = F.when(F.col("size_a") > 0, 1.0).otherwise(0.0).alias("jaccard")
    settled = slim.where(same).select(*pairs.columns, equal)
    others = slim.where(~same).select(*pairs.columns)
    return settled.union(attach(others, grams.select(ID, "grams")).select(*pairs.columns, score))


def set_table(notices: DataFrame) -> DataFrame:
    """``notice_id, grams, size, digest``."""
    body = F.col(BODY)
    return notices.select(ID, H.gram_codes(body).alias("grams"), H.gram_digest(body).alias("_d")).select(
        ID, "grams", "_d.size", "_d.digest"
    )


def size_bound(threshold: float) -> Column:
    """Whether two sets of ``size_a`` and ``size_b`` elements can reach the threshold."""
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return low >= F.lit(threshold) * high - F.lit(1e-9)


def signatures(notices: DataFrame, k: int = 400) -> DataFrame:
    """``notice_id, signature``."""
    return notices.select(ID, H.signature(F.col(BODY), k).alias("signature"))


def minhash_similarity(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs with the estimated similarity."""
    return attach(pairs, sigs.select(ID, "signature")).select(
        *pairs.columns, H.slot_agreement(F.col("signature_a"), F.col("signature_b")).alias("estimate")
    )


def score_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with exact and estimated similarity; ``sets`` has ``grams`` and ``signature``."""
    return attach(pairs, sets.select(ID, "grams", "signature")).select(
        *pairs.columns,
        jaccard(F.col("grams_a"), F.col("grams_b")).alias("jaccard"),
        H.slot_agreement(F.col("signature_a"), F.col("signature_b")).alias("estimate"),
    )


def minhash_error(scored: DataFrame, k: int = 400) -> DataFrame:
    """Adds the error in percent and whether it is within 100/sqrt(k) to pairs with both scores."""
    error = F.abs(F.col("jaccard") - F.col("estimate")) * 100
    return scored.select("*", error.alias("error_pct"), (error <= 100 / k**0.5).alias("within_bound"))


def verify_candidates(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs whose exact similarity reaches the threshold."""
    return jaccard_pairs(pairs, grams).where(F.col("jaccard") >= threshold)


def strategy_grams(
    notices: DataFrame,
    strategies: Sequence[str],
    phrases: Sequence[str] = X.PHRASES,
    span: int = 1400,
) -> DataFrame:
    """One column of trigram sets per cleaning strategy, in one pass over the texts."""
    body = F.col(BODY)
    return notices.select(
        ID,
        *[H.gram_codes(X.cleaner(s, phrases, span)(body)).alias(s) for s in strategies],
    )


def score_strategies(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Exact similarity of every pair under every strategy of :func:`strategy_grams`."""
    scores = F.array(
        *[
            F.struct(
                F.lit(s).alias("strategy"),
                jaccard(F.col(f"{s}_a"), F.col(f"{s}_b")).alias("jaccard"),
            )
            for s in grams.columns
            if s != ID
        ]
    )
    return (
        attach(pairs, grams)
        .select(*pairs.columns, F.explode(scores).alias("s"))
        .select(*pairs.columns, "s.strategy", "s.jaccard")
    )


def evaluate_metric(scores: DataFrame) -> DataFrame:
    """Per strategy the scores of each class, and whether the classes are inverted."""
    def of(label: str) -> Column:
        return F.when(F.col("label") == label, F.col("jaccard"))

    return scores.groupBy("strategy").agg(
        F.count(of("same")).alias("same_pairs"),
        F.avg(of("same")).alias("same_avg"),
        F.min(of("same")).alias("same_min"),
        F.max(of("same")).alias("same_max"),
        F.count(of("different")).alias("different_pairs"),
        F.avg(of("different")).alias("different_avg"),
        F.min(of("different")).alias("different_min"),
        F.max(of("different")).alias("different_max"),
    ).withColumn("inverted", F.col("same_avg") < F.col("different_avg"))


def first_of_class(pairs: DataFrame) -> DataFrame:
    """The first pair of each label in id order.

    ``min`` over the ids keeps one candidate per label and task before the shuffle.
    """
    first = F.min(F.struct(*PAIR)).alias("p")
    return pairs.groupBy("label").agg(first).select("p.*", "label")


def peek(notices: DataFrame, pairs: DataFrame, characters: int = 500) -> DataFrame:
    """Length and opening characters of the notices in ``pairs``."""
    return members(notices, pairs).select(
        ID,
        F.length(BODY).alias("length"),
        F.substring(BODY, 1, characters).alias("opening"),
    )


def portal_volume(notices: DataFrame, portal: str = "portal_id", k: int = 15) -> DataFrame:
    """The ``k`` portals with most notices."""
    return (
        notices.groupBy(portal)
        .agg(F.count("*").alias("notices"))
        .orderBy(F.desc("notices"), portal)
        .limit(k)
    )
