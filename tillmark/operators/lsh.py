"""Banding, buckets, candidate pairs, pruning, lookup and recall.

A bucket that boilerplate or a large group of copies fills may hold a large share of
all notices; listing its pairs would be quadratic.  Where all pairs are needed, equal
notices are folded first and ``block_pairs`` deals what is left of a bucket in small
squares.  Pruning - ``max_bucket`` - happens only where the caller asks for it;
``lsh_candidates`` then shows a denser bucket by its member rows, linear in size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillmark.functions import hashing as H
from tillmark.operators.similarity import ID, PAIR, attach

BUCKET = ("band_id", "bucket_hash")
# Fixed value: buckets above this size count as dense.
DENSE = 50
# Largest rank that Spark limits before a shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# Hits of a lookup that one task adds up: some 100 bytes each in its hash tables.
HITS = 1 << 19


def band_table(sigs: DataFrame, bands: int = 20, rows: int = 20, empty: str = "sentinel") -> DataFrame:
    """``notice_id, bands``: the band keys of each notice in band order.

    Notices without trigrams share all buckets (``empty="sentinel"``) or are left out
    (``empty="drop"``).
    """
    if empty == "drop":
        sigs = sigs.where(F.element_at("signature", 1) != H.EMPTY_SLOT)
    elif empty != "sentinel":
        raise ValueError("empty must be 'sentinel' or 'drop'")
    return sigs.select(ID, H.band_keys(F.col("signature"), bands, rows).alias("bands"))


def buckets_of(banded: DataFrame) -> DataFrame:
    """One ``band_id, bucket_hash, notice_id`` row per band."""
    return banded.select(F.posexplode("bands").alias(*BUCKET), ID)


def buckets_with_prior(banded: DataFrame) -> DataFrame:
    """Bucket rows with ``prior``, the keys of all earlier bands, and the other columns of ``banded``.

    Two members of a bucket meet there for the first time if no entry of ``prior`` is equal in both.
    """
    keys = F.transform("bands", lambda key: F.unhex(key))
    rest = [c for c in banded.columns if c not in (ID, "bands")]
    rows = banded.select(F.posexplode("bands").alias(*BUCKET), ID, *rest, keys.alias("_keys"))
    return rows.withColumn("prior", F.slice("_keys", 1, F.col("band_id"))).drop("_keys")


def bucket_sizes(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy(*BUCKET).agg(F.count("*").alias("size"))


def bucket_histogram(buckets: DataFrame) -> DataFrame:
    """How many buckets of each size a band has."""
    return bucket_sizes(buckets).groupBy("band_id", "size").agg(F.count("*").alias("buckets"))


def pair_volume(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Per band: colliding and dense buckets, and pairs before and after pruning, all by counting."""
    pairs = F.expr("size * (size - 1) div 2")
    dense = F.col("size") > max_bucket
    return (
        bucket_sizes(buckets)
        .where("size > 1")
        .groupBy("band_id")
        .agg(
            F.count("*").alias("colliding_buckets"),
            F.count_if(dense).alias("dense_buckets"),
            F.sum(pairs).alias("pairs"),
            F.sum(F.when(dense, 0).otherwise(pairs)).alias("pairs_after_pruning"),
        )
    )


def bounded_groups(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Buckets of at most ``max_bucket`` notices with their sorted members.

    At most ``max_bucket + 1`` rows per bucket are looked at.  The limit is applied in
    the scan tasks already, so a dense bucket is cut down before the shuffle; a bucket
    that reaches the extra row is dense and left out.
    """
    if max_bucket < 1:
        raise ValueError("max_bucket must be positive")
    if max_bucket >= GROUP_LIMIT:  # no limit would run before the shuffle: drop dense buckets by their size
        small = bucket_sizes(buckets).where(F.col("size") <= max_bucket).select(*BUCKET)
        kept = buckets.join(small, list(BUCKET), "left_semi")
        return kept.groupBy(*BUCKET).agg(F.sort_array(F.collect_list(ID)).alias("members"))
    ranked = Window.partitionBy(*BUCKET).orderBy(ID)
    return (
        buckets.withColumn("_n", F.row_number().over(ranked))
        .where(F.col("_n") <= max_bucket + 1)
        .groupBy(*BUCKET)
        .agg(F.sort_array(F.collect_list(ID)).alias("members"))
        .where(F.size("members") <= max_bucket)
    )


def sparse_groups(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """The bounded groups in which notices collide."""
    return bounded_groups(buckets, max_bucket).where(F.size("members") > 1)


def prune_dense_buckets(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Bucket rows of the buckets that collide and are not dense."""
    return sparse_groups(buckets, max_bucket).select(*BUCKET, F.explode("members").alias(ID))


def bucket_pairs(groups: DataFrame) -> DataFrame:
    """All pairs of the (bounded) member lists, smaller id first, with their bucket."""
    return groups.select(*BUCKET, "members", F.posexplode("members").alias("_i", PAIR[0])).select(
        *BUCKET,
        PAIR[0],
        F.explode(F.expr("slice(members, _i + 2, size(members))")).alias(PAIR[1]),
    )


def candidate_pairs(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Distinct pairs over all bands after pruning."""
    return bucket_pairs(sparse_groups(buckets, max_bucket)).select(*PAIR).distinct()


def dense_members(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Bucket rows of the dense buckets."""
    dense = bucket_sizes(buckets).where(F.col("size") > max_bucket).select(*BUCKET)
    return buckets.join(dense, list(BUCKET), "left_semi").select(*BUCKET, ID)


def lsh_candidates(buckets: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """The whole candidate relation without the quadratic part.

    ``kind = 'pair'`` rows are distinct pairs from sparse buckets; ``kind = 'member'``
    rows list the notices of dense buckets, any two of which are candidates too.
    """
    nothing = F.lit(None)
    pairs = candidate_pairs(buckets, max_bucket).select(
        F.lit("pair").alias("kind"), *PAIR,
        nothing.cast("int").alias("band_id"), nothing.cast("string").alias("bucket_hash"),
    )
    dense = dense_members(buckets, max_bucket)
    members = dense.select(
        F.lit("member").alias("kind"), F.col(ID).alias(PAIR[0]),
        nothing.cast(dense.schema[ID].dataType).alias(PAIR[1]), *BUCKET,
    )
    return pairs.unionByName(members)


def met_in_blocks(buckets: DataFrame, block: int = 256, condition: Column | None = None) -> DataFrame:
    """Pairs that share a bucket, smaller id first, whatever the bucket's size, with the other columns of both.

    A bucket of n notices is dealt by hash into ``n / block`` blocks and its pairs into squares of
    two blocks, so no task holds a dense bucket.  Other columns of ``buckets`` come along, suffixed
    ``_a`` and ``_b``, and may occur in ``condition``, which is checked as pairs are made.  With
    ``prior`` (see ``buckets_with_prior``) a pair is made in the first band that both share and in
    no other; without it once for each.
    """
    sizes = bucket_sizes(buckets).where("size > 1").withColumnRenamed("size", "_size")
    sized = buckets.join(sizes, list(BUCKET))
    parts = F.ceil(F.col("_size") / F.lit(block)).cast("int")
    dealt = sized.withColumn("_parts", parts).withColumn("_own", F.pmod(F.hash(ID), F.col("_parts")))
    rest = [c for c in buckets.columns if c not in (*BUCKET, ID)]

    def side(name: str, others: Column, row: str, column: str) -> DataFrame:
        return dealt.select(
            *BUCKET, F.col(ID).alias(f"{ID}_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in rest],
            F.col("_own").alias(row), F.explode(others).alias(column),
        )

    left = side("a", F.sequence(F.lit(0), F.col("_parts") - 1), "_row", "_column")
    right = side("b", F.sequence(F.lit(0), F.col("_parts") - 1), "_column", "_row")
    wanted = F.col(PAIR[0]) < F.col(PAIR[1])
    if condition is not None:
        wanted &= condition
    met = left.join(right, [*BUCKET, "_row", "_column"]).where(wanted)
    if "prior" in rest:
        earlier = F.exists(F.zip_with("prior_a", "prior_b", lambda x, y: x == y), lambda same: same)
        met = met.where(~earlier).drop("prior_a", "prior_b")
    return met.drop(*BUCKET, "_row", "_column")


def block_pairs(buckets: DataFrame, block: int = 256, condition: Column | None = None) -> DataFrame:
    """Distinct pairs that share a bucket; see ``met_in_blocks``. Rows with ``prior`` need no shuffle of the pairs."""
    pairs = met_in_blocks(buckets, block, condition).select(*PAIR)
    return pairs if "prior" in buckets.columns else pairs.distinct()


def kept_buckets(buckets: DataFrame) -> DataFrame:
    """``band_id, bucket_hash, size`` of the buckets in which notices collide, but one of those with the same members.

    Members are told apart by their number and two hashes of 64 bits. The first band that two
    notices share is never left out: an earlier bucket with the same members would hold both.
    A column ``elements`` of ``buckets`` is added up beside.
    """
    marks = [F.bit_xor(F.xxhash64(*seed, ID)).alias(f"_m{n}") for n, seed in enumerate(((), (F.lit(1),)))]
    told = [c for c in ("elements",) if c in buckets.columns]
    volume = [F.sum(c).alias(c) for c in told]
    sized = buckets.groupBy(*BUCKET).agg(F.count("*").alias("size"), *volume, *marks).where("size > 1")
    one = F.min(F.struct(*BUCKET, *told)).alias("b")
    return sized.groupBy("size", "_m0", "_m1").agg(one).select("b.band_id", "b.bucket_hash", "size", *[f"b.{c}" for c in told])


def squares_of(banded: DataFrame, block: int = 4096, texts: int = 512) -> DataFrame:
    """``notice_id, band_id, square, diagonal, own``: the squares of two blocks that the buckets of ``notice_id, bands, size`` are dealt into.

    A block holds about ``block`` members, or fewer whose trigram sets (``size``) are larger than
    ``texts`` on average; a member goes to as many squares as its bucket has blocks, and a square
    holds two blocks at most. The rows are narrow: what is compared joins them by id.
    """
    buckets = banded.select(F.posexplode("bands").alias(*BUCKET), ID, F.col("size").cast("long").alias("elements"))
    kept = kept_buckets(buckets).withColumnsRenamed({"size": "_size", "elements": "_elements"})
    sized = buckets.select(*BUCKET, ID).join(kept, list(BUCKET))
    parts = F.ceil(F.greatest(F.col("_size") / F.lit(block), F.col("_elements") / F.lit(block * texts))).cast("int")
    dealt = sized.withColumn("_parts", parts).withColumn("own", F.pmod(F.hash(ID), F.col("_parts")))
    spread = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    row, column = F.least("own", "_other"), F.greatest("own", "_other")
    square = F.concat_ws("/", *BUCKET, row, column)
    return spread.select(ID, "band_id", square.alias("square"), (row == column).alias("diagonal"), "own")


def lsh_stats(banded: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Distinct candidate pairs against all possible pairs; no pair is dropped or counted twice.

    Notices with the same bands in all places form a class.  Pairs inside a class are counted;
    pairs of classes weigh the product of their sizes, added up where they meet first.
    """
    classes = banded.groupBy("bands").agg(F.min(ID).alias(ID), F.count("*").alias("n"))
    within = classes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("pairs"))
    between = met_in_blocks(buckets_with_prior(classes)).agg(
        F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("pairs")
    )
    dense = bucket_sizes(buckets_of(banded)).where(F.col("size") > max_bucket).agg(F.count("*").alias("n"))
    counted = banded.agg(F.count("*").alias("notices")).select(
        "notices",
        F.expr("notices * (notices - 1) div 2").alias("possible_pairs"),
        (within.scalar() + between.scalar()).alias("candidate_pairs"),
        dense.scalar().alias("dense_buckets"),
    )
    share = F.try_divide("candidate_pairs", "possible_pairs")
    return counted.withColumn("reduction_pct", 100 * (1 - share))


def survival(s: Column, bands: int = 20, rows: int = 20) -> Column:
    """Probability that a pair of similarity ``s`` shares a bucket."""
    return 1 - F.pow(1 - F.pow(s, rows), bands)


def threshold(bands: int = 20, rows: int = 20) -> float:
    """Similarity at which the curve rises."""
    return (1 / bands) ** (1 / rows)


def s_curve(spark: SparkSession, bands: int = 20, rows: int = 20, points: int = 300) -> DataFrame:
    """The survival curve on evenly spaced similarities from 0 to 1."""
    s = F.col("id") / F.lit(points - 1)
    return spark.range(points).select(s.alias("similarity"), survival(s, bands, rows).alias("probability"))


def bucket_lookup(buckets: DataFrame, band_id: int, bucket_hash: str) -> DataFrame:
    """Notices of one bucket; on a table laid out by bucket only its part is read."""
    return buckets.where((F.col("band_id") == band_id) & (F.col("bucket_hash") == bucket_hash)).select(ID)


def lookup_notices(queries: DataFrame, buckets: DataFrame, max_bucket: int | None = None) -> DataFrame:
    """For each query notice the stored notices it shares a bucket with, and in how many bands.

    All of them, however dense the bucket: hits are counted first and dealt by pair into
    as many tasks as it takes to add up ``HITS`` in each (an action).  Only with ``max_bucket`` are denser buckets not
    expanded: for them ``match_id`` is NULL and ``bands`` counts those the query falls into.
    """
    wanted = queries.select(*BUCKET, F.col(ID).alias("query_id"))
    if max_bucket is None:
        hits = wanted.join(buckets.select(*BUCKET, F.col(ID).alias("match_id")), list(BUCKET)).select("query_id", "match_id")
        hits = hits.where(F.col("match_id") != F.col("query_id"))
        total = hits.count()
        parts = max(buckets.sparkSession.sparkContext.defaultParallelism, -(-total // HITS))
        return hits.repartition(parts, "query_id", "match_id").groupBy("query_id", "match_id").agg(F.count("*").alias("bands"))
    small = bounded_groups(buckets, max_bucket)
    hits = wanted.join(small, list(BUCKET)).select("query_id", F.explode("members").alias("match_id"))
    hits = hits.where(F.col("match_id") != F.col("query_id"))
    dense = bucket_sizes(buckets).where(F.col("size") > max_bucket).select(*BUCKET)
    crowded = wanted.join(dense, list(BUCKET), "left_semi").select(
        "query_id", F.lit(None).cast(buckets.schema[ID].dataType).alias("match_id")
    )
    return hits.unionByName(crowded).groupBy("query_id", "match_id").agg(F.count("*").alias("bands"))


def shared_buckets(pairs: DataFrame, banded: DataFrame) -> DataFrame:
    """Pairs with one row per bucket that both notices share, and one with NULLs if none."""
    both = attach(pairs, banded.select(ID, "bands"))
    hit = F.transform(
        F.col("bands_a"),
        lambda key, i: F.when(
            key == F.get("bands_b", i), F.struct(i.alias("band_id"), key.alias("bucket_hash"))
        ),
    )
    hits = F.filter(hit, lambda h: h.isNotNull())
    return both.select(*pairs.columns, F.explode_outer(hits).alias("_hit")).select(
        *pairs.columns, "_hit.band_id", "_hit.bucket_hash"
    )


def labelled_hits(pairs: DataFrame, banded: DataFrame, max_bucket: int = DENSE) -> DataFrame:
    """Labelled pairs with the shared buckets in total and those that pruning keeps.

    Works on the pairs' own band keys: no candidate list is built.
    """
    dense = (
        bucket_sizes(buckets_of(banded))
        .where(F.col("size") > max_bucket)
        .select(F.col("band_id").alias("_band"), F.col("bucket_hash").alias("_hash"))
    )
    # Pairs without a shared bucket get a key of their own instead of one hot NULL key.
    hits = shared_buckets(pairs, banded).withColumn(
        "_key", F.coalesce("bucket_hash", F.concat_ws("|", *PAIR))
    )
    match = (F.col("_key") == F.col("_hash")) & (F.coalesce("band_id", F.lit(-1)) == F.col("_band"))
    return (
        hits.join(dense, match, "left")
        .groupBy(*pairs.columns)
        .agg(
            F.count("band_id").alias("shared_buckets"),
            (F.count("band_id") - F.count("_band")).alias("kept_buckets"),
        )
    )


def pruning_recall(hits: DataFrame) -> DataFrame:
    """Share of ``same`` pairs that are candidates before and after pruning."""
    counted = hits.where("label = 'same'").agg(
        F.count("*").alias("same_pairs"),
        F.count_if(F.col("shared_buckets") > 0).alias("found_before"),
        F.count_if(F.col("kept_buckets") > 0).alias("found_after"),
    )
    before = F.try_divide("found_before", "same_pairs")
    after = F.try_divide("found_after", "same_pairs")
    return counted.select(
        "*",
        before.alias("recall_before"),
        after.alias("recall_after"),
        (100 * (before - after)).alias("recall_loss_pct"),
    )
