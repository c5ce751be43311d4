"""The retail and notice tables, derived by Spark from the TPC-H-like test tables.

``lineitem`` plays the sales lines, ``part`` the products, ``orders`` the finance
control, ``documents`` the notices.  Every derivation reads its table as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillmark.sources.files import read_spread
from tillmark.staging import stage

# Phrases that many of the test documents share.
PHRASES = ("Licensed under the Apache License, Version 2.0.", "Released under the MIT License.")


# Key to deal a table by: each test table is a single row group, that is a single task.
SPREAD = {"lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id", "events": "event_id"}


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    if name in SPREAD:
        parts = 2 * spark.sparkContext.defaultParallelism
        return read_spread(spark, path, SPREAD[name], *(columns or ("*",)), parts=parts)
    return spark.read.parquet(path).select(*(columns or ("*",)))


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Text-only sales lines; even and odd orders use different header names.

    Keys repeat as re-sent lines do, some quantities and timestamps do not parse, and
    odd orders carry epoch seconds.
    """
    line = table(spark, sf, "lineitem")
    order = F.col("l_orderkey")
    even = order % 2 == 0
    at = F.col("l_shipdate").cast("timestamp").cast("bigint") + order % 86400
    text_at = F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd HH:mm:ss")
    quantity = F.when((F.col("l_quantity") == 49) & (F.col("l_tax") == 0.08), "49 pcs").otherwise(
        F.col("l_quantity").cast("string")
    )
    return line.select(
        bill_no(order).alias("bill_no"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        _if(even, F.concat(F.lit("P"), "l_partkey"), "product_code"),
        _if(~even, F.concat(F.lit("P"), "l_partkey"), "item_code"),
        _if(even, quantity, "qty"),
        _if(~even, quantity, "quantity"),
        _if(even, F.col("l_extendedprice").cast("string"), "unit_price"),
        _if(~even, F.col("l_extendedprice").cast("string"), "rate"),
        _if(even, line_type(), "line_type"),
        _if(~even, line_type(), "type"),
        _if(even, F.when(F.col("l_quantity") == 50, "pending").otherwise(text_at), "ts"),
        _if(~even, at.cast("string"), "txn_time"),
    )


def _if(condition: Column, value: Column, name: str) -> Column:
    return F.when(condition, value).alias(name)


def store_id(order: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad((order % 12 + 1).cast("string"), 2, "0"))


def bill_no(order: Column) -> Column:
    return F.concat_ws("/", store_id(order), order.cast("string"))


def line_type() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(F.col("l_returnflag") == "N", "SALE")
        .when(flags == "RF", "RETURN")
        .when(flags == "RO", "VOID")
        .when(flags == "AF", "DISCOUNT")
        .when(F.col("l_linenumber") % 2 == 0, "TENDER")
        .otherwise("TAX")
    )


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Text-only lines with mixed headers, numbers and timestamps of every kind."""
    event = F.col("event_id")
    even = event % 2 == 0
    code = F.concat(F.lit("E"), F.col("user_id").cast("string"))
    value = F.when(F.col("event_type") == "error", F.concat(F.col("value").cast("string"), F.lit("d")))
    value = value.otherwise(F.col("value").cast("string"))
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    at = (
        F.when(F.col("user_id") % 10 == 3, F.date_format(second, "yyyy-MM"))
        .when(F.col("user_id") % 10 == 4, F.date_format(second, "yyyy/MM/dd HH:mm:ss"))
        .when(F.col("user_id") % 2 == 0, F.date_format(second, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(second.cast("bigint").cast("string"))
    )
    return table(spark, sf, "events").select(
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("bill_no"),
        event.cast("string").alias("line_no"),
        _if(even, code, "product_code"),
        _if(~even, code, "item_code"),
        _if(even, value, "qty"),
        _if(~even, value, "quantity"),
        F.col("value").cast("string").alias("rate"),
        F.col("event_type").alias("type"),
        _if(even, at, "ts"),
        _if(~even, at, "txn_time"),
    )


def stores(spark: SparkSession, sf: str) -> DataFrame:
    """The stores that orders name; ``floor_area_sqft`` and the rest are made from the id."""
    ids = table(spark, sf, "orders").select(store_id(F.col("o_orderkey")).alias("store_id")).distinct()
    return ids.select("store_id", F.concat(F.lit("Store "), "store_id").alias("store_name"))


def categories(spark: SparkSession, sf: str) -> DataFrame:
    brand = F.col("p_brand")
    return (
        table(spark, sf, "part")
        .select(F.replace(brand, F.lit("Brand#"), F.lit("C")).alias("category_id"), brand.alias("category_name"))
        .distinct()
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Products with validity; every fiftieth code was reissued into another category."""
    key = F.col("p_partkey")
    reissued = key % 50 == 0
    open_end = F.when(key % 7 == 0, F.lit(None)).otherwise(F.lit("9999-12-31"))

    def version(sk: Column, category: Column, start: str, end: Column) -> Column:
        return F.struct(
            sk.alias("product_sk"),
            F.concat(F.lit("P"), key.cast("string")).alias("product_code"),
            F.col("p_name").alias("product_name"),
            category.alias("category_id"),
            F.lit(start).cast("date").alias("valid_from"),
            end.cast("date").alias("valid_to"),
        )

    first = version(
        key * 2,
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("C")),
        "1995-06-01",
        F.when(reissued, "1998-06-30").otherwise(open_end),
    )
    second = version(
        key * 2 + 1,
        F.concat(F.lit("C"), (F.col("p_size") % 25 + 1).cast("string")),
        "1998-07-01",
        F.lit("9999-12-31"),
    )
    versions = F.when(reissued, F.array(first, second)).otherwise(F.array(first))
    return table(spark, sf, "part").select(F.explode(versions).alias("v")).select("v.*")


def price_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """A price per product and month with sales, valid to the day before the next one."""
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    reissued = (F.col("l_partkey") % 50 == 0) & (F.col("effective_from") >= "1998-07-01")
    monthly = (
        # Prices shrink to months in the tasks that read them: lines are not dealt out before.
        read_spread(spark, f"{sf}/lineitem.parquet", "l_partkey", "l_partkey", "l_shipdate", "l_extendedprice")
        .groupBy("l_partkey", month.alias("effective_from"))
        .agg(F.max("l_extendedprice").cast("decimal(12,2)").alias("selling_price"))
        .withColumn("product_sk", F.col("l_partkey") * 2 + F.when(reissued, 1).otherwise(0))
    )
    following = F.lead("effective_from").over(Window.partitionBy("product_sk").orderBy("effective_from"))
    end = F.coalesce(F.date_sub(following, 1), F.lit("9999-12-31").cast("date"))
    return monthly.select("product_sk", "selling_price", "effective_from", end.alias("effective_to"))


def finance(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("revenue_inr"))
    )


def notices(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return docs.select(
        F.col("doc_id").alias("notice_id"), F.col("text").alias("body"), F.col("source").alias("portal_id")
    )


def labelled_pairs(texts: DataFrame) -> DataFrame:
    """``same``: each copy with the first notice of equal text up to white space;
    ``different``: each notice with its successor, when their texts differ."""
    fold = F.md5(F.trim(F.regexp_replace("body", r"\s+", " ")).cast("binary"))
    # Narrow and read four times: written once instead of folding the texts again.
    folded = stage(texts.select("notice_id", fold.alias("fold")), "folded")
    first = folded.groupBy("fold").agg(F.min("notice_id").alias("notice_id_a"), F.count("*").alias("n"))
    same = (
        folded.join(first.where("n > 1"), "fold")
        .where("notice_id <> notice_id_a")
        .select("notice_id_a", F.col("notice_id").alias("notice_id_b"), F.lit("same").alias("label"))
    )
    after = folded.select(F.col("notice_id").alias("notice_id_b"), F.col("fold").alias("fold_b"))
    different = (
        folded.join(after, F.col("notice_id") + 1 == F.col("notice_id_b"))
        .where("fold <> fold_b")
        .select(F.col("notice_id").alias("notice_id_a"), "notice_id_b", F.lit("different").alias("label"))
    )
    return same.unionByName(different)
