"""Sharding by jump consistent hashing, in built-in functions only.

A key's shard follows from the key and the shard count alone: no ring, no table. When
shards are appended, a row either stays or goes into a new shard. Slots, the places of the
rows inside a shard, come from per-bucket counts and their prefix sums, so that no task
ever holds a whole shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillmark.llm.common import table
from tillmark.staging import stage

#: Multiplier of the published generator, in two halves of 32 bits.
HIGH, LOW = divmod(2862933555777941757, 1 << 32)
WORD = (1 << 32) - 1
#: More jumps than this have a probability below 1e-40 for any shard count.
JUMPS = 128


def _times(x: Column, y: int) -> Column:
    """Low 32 bits of ``x * y`` for 32-bit values, without overflow of a long."""
    top = F.shiftleft((x * F.lit(y >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (x * F.lit(y & 0xFFFF) + top).bitwiseAND(F.lit(WORD))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """One step ``key * multiplier + 1`` modulo 2**64 on the two halves of a key."""
    first = low * F.lit(LOW & 0xFFFF) + F.lit(1)
    second = low * F.lit(LOW >> 16) + F.shiftright(first, 16)
    new_low = F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16) + first.bitwiseAND(F.lit(0xFFFF))
    carry = F.shiftright(second, 16)
    new_high = (carry + _times(high, LOW) + _times(low, HIGH)).bitwiseAND(F.lit(WORD))
    return new_high, new_low


def key_halves(key: Column) -> tuple[Column, Column]:
    """Stable 64-bit hash of any key: the first 16 hex digits of the md5 of its text. NULL hashes like ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return tuple(
        F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9)
    )


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a key; int."""
    if shards < 1:
        raise ValueError("there must be one shard at least")
    high, low = key_halves(key)
    zero = F.lit(0).cast("long")

    def jump(state: Column, _: Column) -> Column:
        h, l = _next(state["high"], state["low"])
        drawn = F.shiftright(h, 1) + F.lit(1)
        to = F.floor((state["to"] + F.lit(1)) * (F.lit(float(1 << 31)) / drawn.cast("double")))
        done = state["to"] >= F.lit(shards)
        return F.struct(
            F.when(done, state["high"]).otherwise(h).alias("high"),
            F.when(done, state["low"]).otherwise(l).alias("low"),
            F.when(done, state["at"]).otherwise(state["to"]).alias("at"),
            F.when(done, state["to"]).otherwise(to).alias("to"),
        )

    start = F.struct(high.alias("high"), low.alias("low"), zero.alias("at"), zero.alias("to"))
    end = lambda s: F.when(s["to"] >= F.lit(shards), s["at"]).otherwise(
        F.raise_error(F.lit("more jumps than a hash gives")).cast("long")
    )
    steps = F.sequence(F.lit(1), F.lit(min(shards, JUMPS)))
    return F.aggregate(steps, start, jump, end).cast("int")


def place(df: DataFrame, key: str, shards: int, grown: int | None = None) -> DataFrame:
    """``df`` with ``shard`` and, if ``grown`` is given, ``grown_shard``; columns of those names are replaced."""
    df = df.withColumn("shard", jump_shard(F.col(key), shards))
    return df if grown is None else df.withColumn("grown_shard", jump_shard(F.col(key), grown))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Rows as Parquet, one folder a shard; a large shard becomes several files."""
    place(df, key, shards).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def assign(
    df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, appended: int = 1, digits: int = 3
) -> DataFrame:
    """Shard, slot and, after ``appended`` more shards, the new shard of every row (an action).

    Law ``key``. ``size`` is the UTF-8 length of the text plus 1, ``text_crc32`` its CRC-32;
    a NULL text counts as empty, a NULL key as one key of its own. Rows that agree in key,
    size and checksum are counted before the shuffle and get consecutive slots, so neither
    a repeated key nor repeated rows fill a task. The order in a shard is that of an md5 of
    key, size and checksum, whose first ``digits`` hex digits name the bucket a task numbers.
    An empty table gives no rows. Only ``key`` and ``text`` are read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = df.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    counted = place(slim.groupBy("key", "size", "text_crc32").agg(F.count("*").alias("n")), "key", shards, shards + appended)
    named = F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), "size", "text_crc32")
    order = F.md5(named.cast("binary"))
    rows = stage(counted.withColumn("order", order).withColumn("bucket", F.substring("order", 1, digits)), "shards")

    by_shard = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        rows.groupBy("shard", "bucket")
        .agg(F.sum("n").alias("rows"))
        .select("shard", "bucket", F.coalesce(F.sum("rows").over(by_shard), F.lit(0)).alias("before"))
    )
    inside = (
        Window.partitionBy("shard", "bucket")
        .orderBy("order", F.col("key").asc_nulls_first(), "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = rows.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(sums, ["shard", "bucket"])
    first = F.col("before") + F.col("ahead")
    return numbered.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(first, first + F.col("n") - F.lit(1))).alias("slot"),
        "grown_shard",
    )


def op9_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 7, and where each would be with a ninth shard."""
    return assign(table(spark, folder, "documents"))


ORACLE = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS l FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         CAST(xor(list_reduce(
           list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
           lambda a, b: xor(a >> 8, l[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS BIGINT) AS text_crc32
  FROM documents, steps),
jumps(doc_id, key, upto) AS (
  SELECT DISTINCT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS UHUGEINT), CAST(0 AS BIGINT)
  FROM d
  UNION ALL
  SELECT doc_id, nk, CAST(floor((upto + 1) * (CAST(2147483648 AS DOUBLE) / CAST(nk // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (
    SELECT doc_id, upto, (key * CAST(2862933555777941757 AS UHUGEINT) + 1) % CAST(18446744073709551616 AS UHUGEINT) AS nk
    FROM jumps WHERE upto < 9)),
homes AS (
  SELECT doc_id, CAST(max(upto) FILTER (upto < 8) AS INT) AS shard, CAST(max(upto) FILTER (upto < 9) AS INT) AS grown_shard
  FROM jumps GROUP BY doc_id)
SELECT d.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (
         PARTITION BY shard
         ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || size || ':' || text_crc32), d.doc_id, size, text_crc32
       ) - 1 AS slot,
       grown_shard
FROM d JOIN homes ON d.doc_id IS NOT DISTINCT FROM homes.doc_id
"""
