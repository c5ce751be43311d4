"""Registered queries: every operator over the test tables, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillmark.operators import lsh, quality, reports, similarity as sim
from tillmark.operators.dedup import dedup_latest as dedup, load_checksum
from tillmark.operators.facts import revenue_lines, star_fact
from tillmark.operators.intervals import sweep_join
from tillmark.operators.normalise import normalise_lines, rejected_values
from tillmark.plans import notices as near, standins as st
from tillmark.plans.warehouse import LINE_KEY, sales_lines
from tillmark.sources import files, landing, tables
from tillmark.staging import stage, staging_path

Query = Callable[[SparkSession, str], DataFrame]

PERIODS = (
    ("March 1997", dt.date(1997, 3, 1), dt.date(1997, 3, 31)),
    ("October 1997", dt.date(1997, 10, 1), dt.date(1997, 10, 31)),
    ("Year 1999", dt.date(1999, 1, 1), dt.date(1999, 12, 31)),
    ("March 2003", dt.date(2003, 3, 1), dt.date(2003, 3, 31)),
)
STRATEGIES = ("raw", "strip_then_mask", "mask_then_strip", "greedy_block")
SPAN = 600
SMALL = 5
THRESHOLD = 0.8


def _text(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, pattern).alias(column)


def _double(*columns: str) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


# Warehouse -----------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return sales_lines(st.raw_sales(spark, sf))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return star_fact(_lines(spark, sf), st.products(spark, sf))


def normalise(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_lines(st.raw_events(spark, sf)).withColumn("timestamp", _text("timestamp"))


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).withColumn("timestamp", _text("timestamp"))


def checksum(spark: SparkSession, sf: str) -> DataFrame:
    """The load over the files sent once, twice and three times.

    The first load is stored.  Keep-latest over what is stored and what comes again gives the
    same as over all files at once, so the later loads start from it.
    """
    raw = stage(normalise_lines(st.raw_sales(spark, sf)), "raw")
    loaded = [stage(dedup(raw, LINE_KEY, "timestamp"), "load")]
    for _ in range(2):
        loaded.append(dedup(loaded[0].unionAll(raw), LINE_KEY, "timestamp"))
    runs = [load_checksum(lines).select(F.lit(n + 1).alias("times_sent"), "*") for n, lines in enumerate(loaded)]
    return reduce(DataFrame.unionAll, runs)


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with numbers and timestamps out of range: counted, and no end of the load."""
    order = F.col("l_orderkey")
    quantity = F.col("l_quantity").cast("string")
    raw = st.table(spark, sf, "lineitem").select(
        st.bill_no(order).alias("bill_no"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        F.when(order % 10 == 0, "1e30").when(order % 10 == 1, "inf").when(order % 10 == 2, "nan")
        .when(order % 10 == 3, F.concat(quantity, F.lit(" pcs"))).otherwise(quantity).alias("qty"),
        F.when(order % 11 == 0, "1e12").otherwise(F.col("l_extendedprice").cast("string")).alias("rate"),
        F.when(order % 13 == 0, "20240101120000").when(order % 13 == 1, "1704067200000")
        .when(order % 13 == 2, "99999999999999999999").when(order % 13 == 3, "pending")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ts"),
    )
    lines = normalise_lines(raw)
    value = F.sum((F.col("quantity") * F.col("unit_price")).cast("decimal(24,4)")).cast("double")
    kept = lines.agg(F.lit("kept value").alias("columns"), value.alias("rows"))
    return rejected_values(raw).select("columns", F.col("rows").cast("double").alias("rows")).union(kept)


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written as CSV files of two header variants and read back by name."""
    raw = st.raw_sales(spark, sf)
    root = staging_path(spark, "csv")
    first = ["ts", "bill_no", "line_no", "product_code", "qty", "unit_price", "line_type"]
    second = ["bill_no", "line_no", "item_code", "rate", "quantity", "type", "txn_time"]
    for name, columns in (("a", first), ("b", second)):
        part = raw.where(F.col(columns[-1]).isNotNull())
        part.select(columns).write.option("header", "true").csv(f"{root}/{name}")
    lines = normalise_lines(files.read_union_by_name(spark, root)).drop("file_path")
    return lines.withColumn("timestamp", _text("timestamp"))


def land_files(spark: SparkSession, sf: str) -> DataFrame:
    """Four runs over an inbox of a file a store and year, named by its last day: what each rewrote, and at the end (0) what lies there.

    The first lands the files up to 1996, the second finds nothing new. Before the third the later
    files arrive and that of store 3 for 1995 comes again without its returns; the fourth finds nothing.
    """
    order, day = F.col("l_orderkey"), F.col("l_shipdate")
    line = st.table(spark, sf, "lineitem").select(
        st.store_id(order).alias("store"), F.year(day).alias("year"), day.alias("day"), F.col("l_returnflag").alias("flag"),
        st.bill_no(order).alias("bill_no"), F.col("l_linenumber").alias("line_no"),
        F.when(order % 7 == 0, "DRAFT_").otherwise("SALES_").alias("kind"),
    )
    last = line.groupBy("kind", "store", "year").agg(F.date_format(F.max("day"), "yyyyMMdd").alias("last"))
    named = stage(line.join(last, ["kind", "store", "year"]).withColumn("file", F.concat("kind", "store", F.lit("_"), "last", F.lit(".csv"))), "named")
    inbox, tree = staging_path(spark, "inbox"), staging_path(spark, "landed")
    again = "store = 'S03' and year = 1995"
    runs = []
    for number, sent in ((1, named.where("year <= 1996")), (2, None), (3, named.where(f"year > 1996 or ({again} and flag <> 'R')")), (4, None)):
        if sent is not None:
            _send(spark, sent.select("file", "bill_no", "line_no"), inbox)
        runs.append(landing.land_new(spark, inbox, tree, ("csv",)).select(F.lit(number).alias("run"), *landing.LAYOUT, "files", "lines"))
    runs.append(landing.files_and_lines(spark.read.parquet(tree)).select(F.lit(0).alias("run"), *landing.LAYOUT, "files", "lines"))
    return reduce(DataFrame.unionAll, runs)


def _send(spark: SparkSession, lines: DataFrame, inbox: str) -> None:
    """Put lines into the inbox as one CSV file for each value of ``file``, in place of an earlier one of that name."""
    out = staging_path(spark, "sent")
    lines.repartition("file").write.option("header", "true").partitionBy("file").csv(out)
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(inbox)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for status in system.globStatus(jvm.Path(f"{out}/file=*/part-*.csv")):
        place = jvm.Path(target, status.getPath().getParent().getName().removeprefix("file="))
        system.delete(place, False)
        system.rename(status.getPath(), place)


def partition_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The store-months of a quarter, each read from a tree of them."""
    order, day = F.col("o_orderkey"), F.col("o_orderdate")
    tree = staging_path(spark, "tree")
    split = st.table(spark, sf, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"), st.store_id(order).alias("store")
    )
    split.hint("rebalance", "year", "month", "store").write.partitionBy("year", "month", "store").parquet(tree)
    landed = spark.read.parquet(tree)
    months = [files.filter_partition(landed, "S03", 1996, month) for month in (4, 5, 6)]
    return reduce(DataFrame.unionAll, months).select("o_orderkey", "store", "year", "month")


def fallback_files(spark: SparkSession, sf: str) -> DataFrame:
    """All orders from a tree of months with one month's files cut short and one month lost; these come from the mirror."""
    primary, mirror = f"{staging_path(spark, 'primary')}/orders", f"{staging_path(spark, 'mirror')}/orders"
    bills = st.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").cast("int").alias("month"))
    bills.repartition("month").write.partitionBy("month").parquet(mirror)
    jvm = spark._jvm.org.apache.hadoop.fs
    source, target = jvm.Path(mirror), jvm.Path(primary)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    jvm.FileUtil.copy(system, source, system, target, False, True, spark._jsc.hadoopConfiguration())
    for status in system.globStatus(jvm.Path(f"{primary}/month=199603/*.parquet")):
        out = system.create(status.getPath(), True)
        out.write(bytearray(b"PAR1 no more of this"))
        out.close()
    system.delete(jvm.Path(f"{primary}/month=199604"), True)
    return files.read_files_with_fallback(spark, primary, mirror, "o_orderkey long, o_totalprice double, month int")


def finance_file(spark: SparkSession, sf: str) -> DataFrame:
    """The finance control written as CSV and read back typed."""
    path = staging_path(spark, "finance")
    st.finance(spark, sf).write.option("header", "true").csv(path)
    return files.read_finance(spark, path).select("month", *_double("revenue_inr"))


def replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """All orders published with earlier prices, then with a price list that reads the table it replaces."""
    name = f"published_{uuid.uuid4().hex}"
    bills = st.table(spark, sf, "orders")
    tables.publish_version(bills.select("o_orderkey", F.round(F.col("o_totalprice") * 0.9, 2).alias("o_totalprice")), name)
    fresh = bills.select("o_orderkey", F.col("o_totalprice").alias("now"))
    return tables.publish_version(spark.table(name).join(fresh, "o_orderkey").select("o_orderkey", F.col("now").alias("o_totalprice")), name)


def replaced_table_whole(spark: SparkSession, sf: str) -> DataFrame:
    """All orders loaded with earlier prices, then replaced by all orders as they are."""
    name = f"replaced_{uuid.uuid4().hex}"
    bills, price = st.table(spark, sf, "orders"), F.col("o_totalprice")
    for shown in (F.round(price * 0.9, 2), price):
        kept = tables.create_or_replace(bills.select("o_orderkey", shown.alias("o_totalprice")), name)
    return kept


def masters_files(spark: SparkSession, sf: str) -> DataFrame:
    """The product master written as the dump's CSV and read back with its types."""
    from tillmark.sources import external, schemas

    root = staging_path(spark, "masters")
    have = {"products": st.products(spark, sf), "stores": st.stores(spark, sf), "product_categories": st.categories(spark, sf)}
    for name, schema in schemas.MASTERS.items():
        df = have.get(name, st.price_revisions(spark, sf))
        fields = StructType.fromDDL(schema).fieldNames()
        columns = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
        df.select(*columns).write.option("header", "true").csv(f"{root}/{name}.csv")
    read = external.load_masters(spark, root)
    product, revision = read["products"], read["price_revisions"]
    prices = revision.groupBy("product_sk").agg(F.count("*").alias("revisions"), F.max("selling_price").cast("double").alias("highest"))
    shown = product.join(read["product_categories"].select("category_id", "category_name"), "category_id", "left").join(prices, "product_sk", "left")
    return shown.select("product_sk", "product_code", "category_name", _text("valid_from", "yyyy-MM-dd"), "revisions", "highest")


def federated_files(spark: SparkSession, sf: str) -> DataFrame:
    """The federated report over a CSV tree and dimension tables of a folder, in one plan."""
    from tillmark.sources import external

    lines, dims = staging_path(spark, "lines"), staging_path(spark, "dims")
    st.raw_sales(spark, sf).write.option("header", "true").csv(lines)
    st.products(spark, sf).write.parquet(f"{dims}/products")
    st.categories(spark, sf).write.parquet(f"{dims}/product_categories")
    product, category = (external.read_dim(spark, dims, t) for t in ("products", "product_categories"))
    revenue = reports.federated_category(files.read_union_by_name(spark, lines), product, category)
    return revenue.select("category_name", *_double("total_revenue"))


def land_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Daily file names made from orders; names of cancelled days do not fit the pattern."""
    order = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    suffix = F.when(order % 3 == 0, ".parquet").otherwise(".csv")
    name = F.concat(
        F.when(F.col("o_orderpriority") == "5-LOW", "DRAFT_").otherwise("SALES_"),
        st.store_id(order), F.lit("_"), day, suffix,
    )
    names = st.table(spark, sf, "orders").select(name.alias("path")).distinct()
    return (
        landing.parse_names(names)
        .groupBy("year", "month", "store")
        .agg(
            F.count("*").alias("files"),
            F.date_format(F.min("file_date"), "yyyy-MM-dd").alias("first_day"),
            F.date_format(F.max("file_date"), "yyyy-MM-dd").alias("last_day"),
        )
    )


def validity_join(spark: SparkSession, sf: str) -> DataFrame:
    fact = _fact(spark, sf)
    return fact.select("bill_no", "line_no", "product_sk", _text("business_date", "yyyy-MM-dd"))


def validity_join_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue lines without a valid product, by month."""
    fact = _fact(spark, sf).where("product_sk is null")
    return fact.groupBy(F.date_format("business_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("lines")
    )


def star(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).withColumn("business_date", _text("business_date", "yyyy-MM-dd"))


def _pit(bounds: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        revenue = reports.period_revenue(_fact(spark, sf), st.price_revisions(spark, sf), PERIODS, bounds)
        return revenue.select("reporting_period", *_double("total_historical_revenue"))

    return query


def _reconciled(spark: SparkSession, sf: str, missing: str) -> DataFrame:
    monthly = reports.monthly_revenue(_fact(spark, sf))
    return reports.reconcile(st.finance(spark, sf), monthly, missing)


def _reconcile(missing: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _reconciled(spark, sf, missing).select(
            "month", *_double("finance_revenue", "pipeline_revenue", "variance")
        )

    return query


def avg_variance(spark: SparkSession, sf: str) -> DataFrame:
    average = reports.average_variance(_reconciled(spark, sf, "zero"))
    return average.select("months", F.round(F.col("avg_variance").cast("double"), 2).alias("avg_variance"))


def swept_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Every revenue line at the price of its day, by the sweep: lines, priced lines and value by month."""
    sold = stage(_fact(spark, sf).select("product_sk", "business_date", "quantity"), "sold")
    prices = stage(st.price_revisions(spark, sf), "prices")
    priced = sweep_join(sold, prices, ["product_sk"], "business_date", "effective_from", "effective_to", "[]")
    value = F.sum(F.col("quantity").cast("decimal(18,2)") * F.col("selling_price")).cast("double")
    return priced.groupBy(F.date_format("business_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("lines"), F.count("selling_price").alias("priced"), value.alias("list_value")
    )


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return reports.kpis(_fact(spark, sf)).withColumn(
        "pipeline_revenue", F.col("pipeline_revenue").cast("double")
    )


def _by_category(spark: SparkSession, sf: str) -> DataFrame:
    return reports.revenue_by_category(_fact(spark, sf), st.products(spark, sf), st.categories(spark, sf))


def category_topk(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_categories(_by_category(spark, sf)).select("category_name", *_double("revenue"))


def share_of_max(spark: SparkSession, sf: str) -> DataFrame:
    staged = stage(_by_category(spark, sf), "categories")
    return reports.share_of_max(staged, "revenue").select(
        "category_name", *_double("revenue"), F.round("share", 6).alias("share")
    )


def federated_category(spark: SparkSession, sf: str) -> DataFrame:
    revenue = reports.federated_category(
        st.raw_sales(spark, sf), st.products(spark, sf), st.categories(spark, sf)
    )
    return revenue.select("category_name", *_double("total_revenue"))


def federated_category_validity(spark: SparkSession, sf: str) -> DataFrame:
    revenue = reports.federated_category_validity(
        _lines(spark, sf), st.products(spark, sf), st.categories(spark, sf)
    )
    return revenue.select("category_name", *_double("total_revenue"))


def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    counted = {
        name: quality.KeyCounts(st.table(spark, sf, name), name, *groups)
        for name, groups in {
            "lineitem": (["l_orderkey"], ["l_partkey"]),
            "orders": (["o_orderkey"], ["o_custkey"]),
            "part": (["p_partkey"],),
            "customer": (["c_custkey"], ["c_nationkey"]),
            "nation": (["n_nationkey"],),
        }.items()
    }
    line, order, customer = counted["lineitem"], counted["orders"], counted["customer"]
    return quality.violations(
        [
            # No later check reads the counts of this key: they are not stored.
            quality.repeated_keys(st.table(spark, sf, "lineitem", "l_orderkey", "l_linenumber"), "lineitem", ["l_orderkey", "l_linenumber"]),
            order.repeated(["o_orderkey"]),
            counted["part"].repeated(["p_partkey"]),
            line.orphans("l_orderkey", order, "o_orderkey"),
            line.orphans("l_partkey", counted["part"], "p_partkey"),
            order.orphans("o_custkey", customer, "c_custkey"),
            customer.orphans("c_nationkey", counted["nation"], "n_nationkey"),
            quality.missing_values(_lines(spark, sf), "sales", ["bill_no", "quantity", "timestamp"]),
        ]
    )


def _star_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    lines = stage(_lines(spark, sf), "sales_fact")
    fact = stage(star_fact(lines, st.products(spark, sf)), "fact_sales")
    return {
        "dim_store": st.stores(spark, sf),
        "dim_category": st.categories(spark, sf),
        "dim_product": st.products(spark, sf),
        "sales_fact": lines,
        "fact_sales": fact,
    }


def table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return tables.inventory(_star_tables(spark, sf))


def dashboard_json(spark: SparkSession, sf: str) -> DataFrame:
    from tillmark.plans.warehouse import dashboard

    return dashboard(_star_tables(spark, sf), st.finance(spark, sf))


# Notices -------------------------------------------------------------------


def _clean(strategy: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        cleaned = sim.clean_text(st.notices(spark, sf), strategy, st.PHRASES, SPAN)
        return cleaned.select(
            "notice_id",
            F.length("body").alias("characters"),
            F.md5(F.col("body").cast("binary")).alias("digest"),
        )

    return query


def _grams(spark: SparkSession, sf: str) -> DataFrame:
    return near.grams(st.notices(spark, sf), phrases=st.PHRASES)


def _bands(spark: SparkSession, sf: str) -> DataFrame:
    return near.staged_bands(st.notices(spark, sf), phrases=st.PHRASES)


def _buckets(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.buckets_of(_bands(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return stage(st.labelled_pairs(st.notices(spark, sf)), "pairs")


def trigram_counts(spark: SparkSession, sf: str) -> DataFrame:
    from tillmark.functions.hashing import gram_totals

    cleaned = sim.clean_text(st.notices(spark, sf), "mask_then_strip", st.PHRASES)
    return cleaned.select("notice_id", gram_totals(F.col("body")).alias("t")).select("notice_id", "t.trigrams", "t.hash_sum")


def labelled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return st.labelled_pairs(st.notices(spark, sf))


def first_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return sim.first_of_class(st.labelled_pairs(st.notices(spark, sf)))


def peek(spark: SparkSession, sf: str) -> DataFrame:
    return sim.peek(st.notices(spark, sf), first_pairs(spark, sf))


def jaccard_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return near.exact_scores(st.notices(spark, sf), _pairs(spark, sf), phrases=st.PHRASES)


def evaluate_metric(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    scores = near.strategy_scores(st.notices(spark, sf), pairs, STRATEGIES, st.PHRASES, SPAN)
    return sim.evaluate_metric(scores).select(
        "strategy", "same_pairs", F.round("same_avg", 6).alias("same_avg"), "same_min", "same_max",
        "different_pairs", F.round("different_avg", 6).alias("different_avg"),
        "different_min", "different_max", "inverted",
    )


def minhash_signature(spark: SparkSession, sf: str) -> DataFrame:
    sigs = sim.signatures(sim.clean_text(st.notices(spark, sf), "mask_then_strip", st.PHRASES))
    total = F.aggregate("signature", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return sigs.select(
        "notice_id",
        total.alias("slot_sum"),
        F.element_at("signature", 1).cast("bigint").alias("first_slot"),
        F.element_at("signature", -1).cast("bigint").alias("last_slot"),
    )


def minhash_error(spark: SparkSession, sf: str) -> DataFrame:
    errors = near.estimate_errors(st.notices(spark, sf), _pairs(spark, sf), phrases=st.PHRASES)
    return errors.withColumn("error_pct", F.round("error_pct", 6))


def lsh_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return _buckets(spark, sf)


def _candidates(max_bucket: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return lsh.lsh_candidates(_buckets(spark, sf), max_bucket)

    return query


def lsh_stats(spark: SparkSession, sf: str) -> DataFrame:
    banded = _bands(spark, sf)
    stats = lsh.lsh_stats(banded)
    return stats.withColumn("reduction_pct", F.round("reduction_pct", 6))


def bucket_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.bucket_histogram(_buckets(spark, sf))


def pair_volume(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.pair_volume(_buckets(spark, sf), SMALL)


def prune_dense(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.prune_dense_buckets(_buckets(spark, sf), SMALL)


def pruning_recall(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.pruning_recall(lsh.labelled_hits(_pairs(spark, sf), _bands(spark, sf), SMALL))


def bucket_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The stored notices that the first notice of each repeated text would meet."""
    banded = _bands(spark, sf)
    heads = _pairs(spark, sf).where("label = 'same'").select(F.col("notice_id_a").alias("notice_id")).distinct()
    queries = lsh.buckets_of(banded.join(heads, "notice_id", "left_semi"))
    return lsh.lookup_notices(queries, lsh.buckets_of(banded))


def verify_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_duplicates(st.notices(spark, sf), THRESHOLD, phrases=st.PHRASES)


def near_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Group and number of links of every notice, without a list of pairs."""
    return near.near_groups(st.notices(spark, sf), THRESHOLD, phrases=st.PHRASES)[0].drop("head")


def s_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Survival probability at the exact similarity of each labelled pair, beside what happened."""
    pairs = _pairs(spark, sf)
    exact = near.exact_scores(st.notices(spark, sf), pairs, phrases=st.PHRASES)
    hits = lsh.labelled_hits(pairs, _bands(spark, sf))
    s = F.col("jaccard")
    return exact.join(hits, pairs.columns).select(
        *pairs.columns,
        F.round(lsh.survival(s, 20, 20), 6).alias("b20_r20"),
        F.round(lsh.survival(s, 50, 8), 6).alias("b50_r8"),
        (F.col("shared_buckets") > 0).alias("is_candidate"),
    )


def notices_load(spark: SparkSession, sf: str) -> DataFrame:
    """Notices in CSV and Parquet parts, some ids sent again with a later text; one text per id remains."""
    root = staging_path(spark, "notices")
    docs = st.table(spark, sf, "documents", "doc_id", "text", "source")
    sent = docs.select(
        F.col("source").alias("portal_id"), F.col("doc_id").alias("notice_id"),
        F.lit("2024-01-01").alias("published_at"), F.col("text").alias("body"),
    )
    again = sent.where("notice_id % 10 = 0").withColumn("published_at", F.lit("2024-02-01")).withColumn("body", F.concat(F.lit("AMENDED "), "body"))
    sent.where("notice_id % 2 = 0").write.option("header", "true").option("escape", '"').csv(f"{root}/csv")
    sent.where("notice_id % 2 = 1").unionByName(again).select("notice_id", "body", "portal_id", "published_at").write.parquet(f"{root}/parquet")
    settled = near.unique_notices(files.read_notices(spark, root), "published_at")
    return settled.select("notice_id", "portal_id", "published_at", F.md5(F.trim(F.regexp_replace("body", r"\s+", " ")).cast("binary")).alias("digest"))


def stored_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Size and first member of each bucket of the first notice of each repeated text, from the stored, hashed table."""
    banded = _bands(spark, sf)
    stored = tables.write_buckets(lsh.buckets_of(banded), f"buckets_{uuid.uuid4().hex}", 8)
    heads = _pairs(spark, sf).where("label = 'same'").select(F.col("notice_id_a").alias("notice_id")).distinct()
    asked = lsh.buckets_of(banded.join(heads, "notice_id", "left_semi")).select(*lsh.BUCKET).distinct()
    sizes = stored.join(asked, list(lsh.BUCKET), "left_semi").groupBy(*lsh.BUCKET)
    return sizes.agg(F.count("*").alias("notices"), F.min("notice_id").alias("first_id"))


def stored_lookup_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Members of the same buckets."""
    banded = _bands(spark, sf)
    stored = tables.write_buckets(lsh.buckets_of(banded), f"buckets_{uuid.uuid4().hex}", 8)
    heads = _pairs(spark, sf).where("label = 'same'").select(F.col("notice_id_a").alias("notice_id")).distinct()
    asked = lsh.buckets_of(banded.join(heads, "notice_id", "left_semi")).select(*lsh.BUCKET).distinct()
    return stored.join(asked, list(lsh.BUCKET), "left_semi").select(*lsh.BUCKET, "notice_id")


def portal_volume(spark: SparkSession, sf: str) -> DataFrame:
    docs = st.table(spark, sf, "documents").select(F.col("source").alias("portal_id"))
    return sim.portal_volume(docs)


QUERIES: dict[str, Query] = {
    "normalise_lines": normalise,
    "dedup_latest": dedup_latest,
    "load_checksum": checksum,
    "rejected_values": rejected,
    "union_by_name": union_by_name,
    "land_files": land_files,
    "partition_filter": partition_filter,
    "fallback_files": fallback_files,
    "finance_file": finance_file,
    "replaced_table": replaced_table,
    "replaced_table_whole": replaced_table_whole,
    "masters_files": masters_files,
    "federated_files": federated_files,
    "land_partitions": land_partitions,
    "validity_join": validity_join,
    "validity_join_gaps": validity_join_gaps,
    "star_fact": star,
    "pit_revenue_halfopen": _pit("[)"),
    "pit_revenue_closed": _pit("[]"),
    "swept_prices": swept_prices,
    "monthly_reconcile": _reconcile("null"),
    "monthly_reconcile_zero": _reconcile("zero"),
    "avg_variance": avg_variance,
    "kpis": kpis,
    "category_topk": category_topk,
    "share_of_max": share_of_max,
    "federated_category": federated_category,
    "federated_category_validity": federated_category_validity,
    "key_violations": key_violations,
    "table_inventory": table_inventory,
    "dashboard_json": dashboard_json,
    **{f"clean_{s}": _clean(s) for s in (*STRATEGIES, "block", "block_and_footer", "typed")},
    "trigram_counts": trigram_counts,
    "labelled_pairs": labelled_pairs,
    "first_pairs": first_pairs,
    "peek": peek,
    "jaccard_pairs": jaccard_pairs,
    "evaluate_metric": evaluate_metric,
    "minhash_signature": minhash_signature,
    "minhash_error": minhash_error,
    "lsh_buckets": lsh_buckets,
    "lsh_candidates": _candidates(lsh.DENSE),
    "lsh_candidates_dense": _candidates(SMALL),
    "lsh_stats": lsh_stats,
    "bucket_histogram": bucket_histogram,
    "pair_volume": pair_volume,
    "prune_dense": prune_dense,
    "pruning_recall": pruning_recall,
    "bucket_lookup": bucket_lookup,
    "verify_candidates": verify_candidates,
    "near_groups": near_groups,
    "s_curve": s_curve,
    "notices_load": notices_load,
    "stored_lookup": stored_lookup,
    "stored_lookup_bands": stored_lookup_bands,
    "portal_volume": portal_volume,
}
