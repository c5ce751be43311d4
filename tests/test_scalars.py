import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillmark.functions import scalars as S


def values(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_numbers_that_do_not_parse_become_null(spark):
    texts = ["3", " -2.5e1 ", "3d", "2f", "", "x", None, ".5", "1.", "+7", "1,000"]
    assert values(spark, texts, S.try_number) == [3.0, -25.0, None, None, None, None, None, 0.5, 1.0, 7.0, None]
    hostile = ["1e30", "-1e30", "inf", "-Infinity", "nan", "1e9", "1000000001", "1e999"]
    assert values(spark, hostile, S.try_number) == [None] * 5 + [1e9, None, None]


def test_timestamps_epoch_text_and_garbage(spark):
    texts = ["1704067200", "2024-01-01 10:20:30", "2024-01-01", "2024/01/02 03:04:05", "2024", "2024-01",
             "garbage", None, "", "2024-13-01", "99999999999999999999"]
    got = values(spark, texts, lambda c: F.date_format(S.normalise_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
    # A bare year is all digits: it counts as epoch seconds, like every other number.
    assert got == ["2024-01-01 00:00:00", "2024-01-01 10:20:30", "2024-01-01 00:00:00", "2024-01-02 03:04:05",
                   "1970-01-01 00:33:44", None, None, None, None, None, None]


@pytest.mark.parametrize("digits", ["1704067200000", "20240101120000", "123456789012345678", "9223372036854775807", "9" * 19, "9" * 20])
def test_long_digit_texts_are_no_timestamps(spark, digits):
    assert values(spark, [digits], S.normalise_timestamp) == [None]


def test_rejected_values_are_counted(spark):
    from tillmark.operators.normalise import normalise_lines, rejected_values

    raw = spark.createDataFrame(
        [("b1", "1", "2", "1e30", "20240101120000"), ("b2", "1", "inf", "5", "1704067200"), ("b3", "1", None, None, None)],
        "bill_no string, line_no string, qty string, rate string, ts string",
    )
    assert {r["columns"]: r["rows"] for r in rejected_values(raw).collect()} == {"quantity": 1, "unit_price": 1, "timestamp": 1}
    lines = normalise_lines(raw)
    assert lines.count() == 3 and lines.selectExpr("sum(quantity * unit_price)").first()[0] is None


def test_file_names(spark):
    names = ["in/SALES_S01_20240131.csv", "SALES_S12_20240229.parquet", "SALES_S1_2024.csv", "other.csv"]
    assert values(spark, names, S.file_store) == ["S01", "S12", "", ""]
    assert values(spark, names, S.file_business_date) == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), None, None]


def test_bill_parts(spark):
    bills = ["S01/20241206/00036", "S01", "S02/xx/1"]
    assert values(spark, bills, S.store_of_bill) == ["S01", "S01", "S02"]
    assert values(spark, bills, S.bill_business_date) == [dt.date(2024, 12, 6), None, None]


@pytest.mark.parametrize(
    "function, expected",
    [(S.day_name, "Friday"), (S.month_name, "December"), (S.month_key, "2024-12")],
)
def test_calendar_names(spark, function, expected):
    assert values(spark, ["2024-12-06"], lambda c: function(F.to_date(c))) == [expected]
