"""Aggregations over the star fact.

Each report first reduces the fact to one row per grouping key inside the scan
tasks, and joins dimensions to that small result instead of to the lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillmark.functions import scalars as S
from tillmark.operators.intervals import interval_join
from tillmark.operators.normalise import coalesce_columns


def kpis(fact: DataFrame) -> DataFrame:
    """Fact rows, revenue, distinct stores and distinct products (NULL not counted).

    Distinct counts run over the (store, product) combinations, not over the lines.
    """
    combos = fact.groupBy("store_id", "product_sk").agg(
        F.count("*").alias("n"), F.sum(S.money(F.col("line_revenue"))).alias("revenue")
    )
    return combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
        F.sum("revenue").alias("pipeline_revenue"),
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("product_sk").alias("products"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy(S.month_key(F.col("business_date")).alias("month")).agg(
        F.sum(S.money(F.col("line_revenue"))).alias("pipeline_revenue")
    )


def reconcile(finance: DataFrame, monthly: DataFrame, missing: str = "null") -> DataFrame:
    """Control months with pipeline revenue and variance, by month.

    A control month without pipeline revenue has a NULL variance, or counts as zero
    revenue with ``missing="zero"``, where all amounts are rounded to two digits.
    Pipeline months without control row do not appear.
    """
    joined = finance.select("month", F.col("revenue_inr").alias("finance_revenue")).join(
        monthly, "month", "left"
    )
    if missing == "zero":
        pipeline = F.coalesce(F.col("pipeline_revenue"), F.lit(0))
        joined = joined.select(
            "month",
            F.round("finance_revenue", 2).alias("finance_revenue"),
            F.round(pipeline, 2).alias("pipeline_revenue"),
            F.round(pipeline - F.col("finance_revenue"), 2).alias("variance"),
        )
    elif missing == "null":
        joined = joined.select(
            "month",
            "finance_revenue",
            "pipeline_revenue",
            (F.col("pipeline_revenue") - F.col("finance_revenue")).alias("variance"),
        )
    else:
        raise ValueError("missing must be 'null' or 'zero'")
    return joined.orderBy("month")


def average_variance(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(
        F.count("variance").alias("months"), F.avg("variance").alias("avg_variance")
    )


def share_of_max(df: DataFrame, value: str) -> DataFrame:
    """Each value over the largest one; the maximum is a scalar subquery, not a window."""
    return df.withColumn("share", F.col(value).cast("double") / df.agg(F.max(value)).scalar().cast("double"))


def revenue_by_category(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Revenue rounded to two digits per category of the sold product."""
    per_product = fact.groupBy("product_sk").agg(F.sum(S.money(F.col("line_revenue"))).alias("revenue"))
    return (
        per_product.join(products.select("product_sk", "category_id"), "product_sk")
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name")
        .agg(F.round(F.sum("revenue"), 2).alias("revenue"))
    )


def top_categories(by_category: DataFrame, k: int = 8) -> DataFrame:
    return by_category.orderBy(F.desc("revenue"), "category_name").limit(k)


def federated_category(
    raw: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """Raw file lines joined to products by code alone, revenue per category.

    Neither de-duplicated nor filtered by line type; a code that was reissued counts
    for each of its products, and lines that only carry ``item_code`` do not join.
    """
    value = S.try_number(coalesce_columns(raw, "quantity")) * S.try_number(
        coalesce_columns(raw, "unit_price")
    )
    code = F.col("product_code") if "product_code" in raw.columns else F.lit(None).cast("string")
    per_code = (
        raw.select(code.alias("product_code"), S.money(value).alias("value"))
        .where("product_code is not null")
        .groupBy("product_code")
        .agg(F.sum("value").alias("value"))
    )
    return (
        per_code.join(products.select("product_code", "category_id"), "product_code")
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name")
        .agg(F.sum("value").alias("total_revenue"))
    )


def federated_category_validity(
    lines: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    """The same with normalised lines and the product that was valid on the day."""
    per_day = (
        lines.groupBy("product_code", F.to_date("timestamp").alias("business_date"))
        .agg(F.sum(S.money(F.col("quantity") * F.col("unit_price"))).alias("value"))
    )
    validity = products.select("product_code", "category_id", "valid_from", "valid_to")
    return (
        interval_join(
            per_day, validity, ["product_code"], "business_date", "valid_from", "valid_to", "[]", "inner"
        )
        .join(categories.select("category_id", "category_name"), "category_id")
        .groupBy("category_name")
        .agg(F.sum("value").alias("total_revenue"))
    )


def period_revenue(
    fact: DataFrame,
    revisions: DataFrame,
    periods: Sequence[tuple[str, dt.date, dt.date]],
    bounds: str = "[)",
) -> DataFrame:
    """Point-in-time revenue of SALE lines per period ``(label, first day, last day)``.

    Quantities are summed per product and day before prices are joined: the join sees
    days, not lines, and a hot product has no more rows than days.  Revisions outside
    all periods are left out before the join.  ``bounds="[)"`` loses sales on the last day of a
    revision whose end is its last valid day; ``"[]"`` prices them.  A period without
    priced sales has NULL revenue.
    """
    day = F.col("business_date")
    labels = F.filter(
        F.array(
            *[F.when(day.between(F.lit(a), F.lit(b)), F.lit(label)) for label, a, b in periods]
        ),
        lambda label: label.isNotNull(),
    )
    inside, touching = F.lit(False), F.lit(False)
    for _, a, b in periods:
        inside = inside | day.between(F.lit(a), F.lit(b))
        until = F.col("effective_to").isNull() | (F.col("effective_to") >= F.lit(a))
        touching = touching | ((F.col("effective_from") <= F.lit(b)) & until)
    sold = (
        fact.where((F.col("line_type") == "SALE") & inside & F.col("product_sk").isNotNull())
        .groupBy("product_sk", "business_date")
        .agg(F.sum(F.col("quantity").cast("decimal(18,6)")).cast("decimal(24,6)").alias("quantity"))
    )
    prices = revisions.where(touching).select(
        "product_sk", "selling_price", "effective_from", "effective_to"
    )
    priced = interval_join(
        sold, prices, ["product_sk"], "business_date", "effective_from", "effective_to", bounds, "inner"
    )
    totals = (
        priced.select(
            F.explode(labels).alias("reporting_period"),
            (F.col("quantity") * F.col("selling_price")).alias("revenue"),
        )
        .groupBy("reporting_period")
        .agg(F.sum("revenue").alias("total_historical_revenue"))
    )
    names = F.array(*[F.lit(label) for label, _, _ in periods])
    wanted = fact.sparkSession.range(1).select(F.explode(names).alias("reporting_period"))
    return wanted.join(totals, "reporting_period", "left")


def dashboard(
    fact_kpis: DataFrame, monthly: DataFrame, categories: DataFrame, tables: DataFrame
) -> DataFrame:
    """One row with the nested report as JSON.

    The arrays hold one entry per month, reported category and table: all are the
    reports' own small results, ordered here because aggregation order is free.
    """
    month = F.struct("month", F.col("finance_revenue").alias("finance"),
                     F.col("pipeline_revenue").alias("pipeline"), "variance")
    best_first = F.struct((-F.col("revenue")).alias("_order"), F.col("category_name").alias("name"), "revenue")
    table = F.struct(F.col("table_name").alias("name"), F.col("row_count").alias("rows"))
    k = fact_kpis.select(F.struct("*").alias("kpis"))
    m = monthly.agg(F.sort_array(F.collect_list(month)).alias("monthly"))
    c = categories.agg(
        F.transform(
            F.sort_array(F.collect_list(best_first)),
            lambda x: F.struct(x["name"].alias("name"), x["revenue"].alias("revenue")),
        ).alias("categories")
    )
    t = tables.agg(F.sort_array(F.collect_list(table)).alias("tables"))
    payload = F.struct("kpis", m.scalar().alias("monthly"), c.scalar().alias("categories"), t.scalar().alias("tables"))
    return k.select(F.to_json(payload).alias("payload"))
