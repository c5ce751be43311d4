"""Star-schema fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillmark.functions import scalars as S
from tillmark.operators.intervals import interval_join

# The line types that carry revenue; TENDER and TAX lines repeat it.
REVENUE_TYPES = ("SALE", "VOID", "RETURN", "DISCOUNT")


def revenue_lines(lines: DataFrame, types: Sequence[str] = REVENUE_TYPES) -> DataFrame:
    """Lines of the given types, case-sensitive; NULL types fall out."""
    return lines.where(F.col("line_type").isin(*types))


def business_date(source: str = "timestamp") -> Column:
    """Date of the timestamp in the session zone, or the date that the file name carries."""
    if source == "timestamp":
        return F.to_date("timestamp")
    if source == "filename":
        return S.file_business_date(F.col("file_path"))
    if source == "bill":
        return S.bill_business_date(F.col("bill_no"))
    raise ValueError("source must be 'timestamp', 'filename' or 'bill'")


def star_fact(
    lines: DataFrame,
    products: DataFrame,
    date_source: str = "timestamp",
) -> DataFrame:
    """Revenue lines with store, surrogate product key, revenue and calendar names.

    The product is the one whose validity, both ends included, holds the business
    date; a line without such a product stays with a NULL key.
    """
    dated = revenue_lines(lines).withColumn("business_date", business_date(date_source))
    validity = products.select("product_code", "product_sk", "valid_from", "valid_to")
    joined = interval_join(
        dated, validity, ["product_code"], "business_date", "valid_from", "valid_to", "[]", "left"
    )
    day = F.col("business_date")
    return joined.select(
        "bill_no",
        "line_no",
        S.store_of_bill(F.col("bill_no")).alias("store_id"),
        "product_sk",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
        "business_date",
        S.day_name(day).alias("day_of_week"),
        S.month_name(day).alias("sales_month"),
        "line_type",
    )
