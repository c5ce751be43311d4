"""Scalar expressions for the sales side: tolerant casts, timestamps, calendar, names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Shapes of text that count as a number, an epoch and a timestamp.
NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
EPOCH = r"^[0-9]+$"
CALENDAR = r"^\s*\d{1,6}([-/])\d{1,2}\1\d{1,2}([ T].*)?$"
SALES_FILE = r"SALES_(S\d+)_(\d{4})(\d{2})(\d{2})\.(csv|parquet)"

# Money is summed exactly: a double line value becomes this before any sum.
MONEY = "decimal(24,4)"
# Quantities and prices beyond this are no such things; products and sums of the rest fit MONEY.
LARGEST = 1e9
# Epoch seconds up to the end of the year 9999.
LAST_SECOND = 253_402_300_799


def try_number(text: Column) -> Column:
    """Text to DOUBLE, NULL where it is no number or one beyond ``LARGEST``, infinite or NaN.

    The shape test keeps out Java literals such as ``3d`` that Spark would accept.  What is
    rejected here is counted by ``operators.normalise.rejected_values``.
    """
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(value) <= F.lit(LARGEST)), value)


def normalise_timestamp(text: Column) -> Column:
    """All-digit text is epoch seconds, other text a local timestamp, the rest NULL.

    Text needs a full calendar date: a bare year is not one.  Numbers beyond the year 9999
    (milliseconds, ``yyyyMMddHHmmss``) are no epoch seconds: NULL.
    """
    dashed = F.when(
        text.contains("/"), F.regexp_replace(text, r"^(\s*\d+)/(\d+)/", "$1-$2-")
    ).otherwise(text)
    local = F.when(text.rlike(CALENDAR), dashed.try_cast("timestamp"))
    seconds = text.try_cast("bigint")
    epoch = F.timestamp_seconds(F.when(seconds <= F.lit(LAST_SECOND), seconds))
    return F.when(text.rlike(EPOCH), epoch).otherwise(local)


def store_of_bill(bill_no: Column) -> Column:
    return F.split_part(bill_no, F.lit("/"), F.lit(1))


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def file_store(path: Column) -> Column:
    """Store of a landed file name; empty text when the name does not fit."""
    return F.regexp_extract(path, SALES_FILE, 1)


def file_year(path: Column) -> Column:
    return F.regexp_extract(path, SALES_FILE, 2)


def file_month(path: Column) -> Column:
    return F.regexp_extract(path, SALES_FILE, 3)


def file_business_date(path: Column) -> Column:
    """Business date that the file name carries, NULL when it carries none."""
    return F.try_to_date(
        F.concat(*[F.regexp_extract(path, SALES_FILE, g) for g in (2, 3, 4)]), "yyyyMMdd"
    )


def bill_business_date(bill_no: Column) -> Column:
    """Business date in the middle part of a ``store/yyyyMMdd/serial`` bill number."""
    return F.try_to_date(F.regexp_extract(bill_no, r"^[^/]*/(\d{8})/", 1), "yyyyMMdd")


def money(value: Column) -> Column:
    return value.cast(MONEY)
