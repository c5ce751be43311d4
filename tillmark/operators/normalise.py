"""Raw sales lines to one typed shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillmark.functions import scalars as S

# The header names that mean the same column.
SYNONYMS = {
    "product_code": ("product_code", "item_code"),
    "quantity": ("qty", "quantity"),
    "unit_price": ("unit_price", "rate"),
    "line_type": ("line_type", "type"),
    "timestamp": ("ts", "txn_time"),
}


def coalesce_columns(df: DataFrame, target: str) -> Column:
    """First non-NULL of the header synonyms; NULL text when the input has none of them."""
    present = [F.col(name) for name in SYNONYMS[target] if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def normalise_lines(raw: DataFrame, line_no_type: str = "string") -> DataFrame:
    """Typed lines from text columns; a value that does not parse becomes NULL.

    ``file_path`` is kept when present, so that the business date can come from it.
    """
    text = {name: coalesce_columns(raw, name) for name in SYNONYMS}
    line_no = F.col("line_no") if line_no_type == "string" else F.col("line_no").try_cast(line_no_type)
    columns = [
        F.col("bill_no"),
        line_no.alias("line_no"),
        text["product_code"].alias("product_code"),
        S.try_number(text["quantity"]).alias("quantity"),
        S.try_number(text["unit_price"]).alias("unit_price"),
        text["line_type"].alias("line_type"),
        S.normalise_timestamp(text["timestamp"]).alias("timestamp"),
    ]
    if "file_path" in raw.columns:
        columns.append(F.col("file_path"))
    return raw.select(*columns)


def rejected_values(raw: DataFrame) -> DataFrame:
    """``columns, rows``: texts of quantity, price and timestamp that became NULL, one pass, a row each."""
    readers = {"quantity": S.try_number, "unit_price": S.try_number, "timestamp": S.normalise_timestamp}
    texts = {name: coalesce_columns(raw, name) for name in readers}
    counts = raw.agg(*[F.count_if(t.isNotNull() & readers[n](t).isNull()).alias(n) for n, t in texts.items()])
    entries = F.array(*[F.struct(F.lit(n).alias("columns"), F.col(n).alias("rows")) for n in readers])
    return counts.select(F.explode(entries).alias("e")).select("e.columns", "e.rows")
