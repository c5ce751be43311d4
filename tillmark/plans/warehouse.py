"""Retail warehouse: load, star schema, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillmark.operators import reports
from tillmark.operators.dedup import dedup_latest, load_checksum
from tillmark.operators.facts import star_fact
from tillmark.operators.normalise import normalise_lines
from tillmark.sources import files, tables

LINE_KEY = ("bill_no", "line_no")


def sales_lines(raw: DataFrame, line_no_type: str = "string") -> DataFrame:
    """Typed raw lines with the newest version of every (bill, line)."""
    return dedup_latest(normalise_lines(raw, line_no_type), LINE_KEY, "timestamp")


def load_sales(
    spark: SparkSession,
    root: str,
    table: str = "sales_fact",
    formats: Sequence[str] = ("csv", "parquet"),
    mirror: str | None = None,
) -> DataFrame:
    """Rebuild the sales table from all landed files and return its checksum (an action).

    Running it again over the same or re-sent files gives the same table.
    """

    def read(source: str) -> DataFrame:
        return sales_lines(files.read_sales(spark, source, tuple(formats)))

    def write(lines: DataFrame) -> DataFrame:
        return tables.create_or_replace(lines, table)

    loaded = files.read_with_fallback(read, root, mirror, write) if mirror else write(read(root))
    return load_checksum(loaded)


def build_star(
    spark: SparkSession,
    masters: dict[str, DataFrame],
    sales_table: str = "sales_fact",
    date_source: str = "timestamp",
) -> dict[str, DataFrame]:
    """Write the three dimensions and the fact, and return them by table name (an action)."""
    written = {
        "dim_store": masters["stores"],
        "dim_category": masters["product_categories"],
        "dim_product": masters["products"],
        "fact_sales": star_fact(spark.table(sales_table), masters["products"], date_source),
    }
    return {name: tables.create_or_replace(df, name) for name, df in written.items()}


def dashboard(star: dict[str, DataFrame], finance: DataFrame) -> DataFrame:
    """The report payload over the star tables."""
    fact = star["fact_sales"]
    by_category = reports.revenue_by_category(fact, star["dim_product"], star["dim_category"])
    return reports.dashboard(
        reports.kpis(fact),
        reports.reconcile(finance, reports.monthly_revenue(fact), "zero"),
        reports.top_categories(by_category),
        tables.inventory(star),
    )
