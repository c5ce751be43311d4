import re

import pytest
from hypothesis import given, settings, strategies as hs, HealthCheck
from pyspark.sql import functions as F

from tillmark.functions import hashing as H, text as X


def apply(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def windows(text):
    low = text.lower()
    return {low[i : i + 3] for i in range(len(low) - 2)}


TEXTS = ["", "a", "ab", "abc", "aaaa", "Line\nbreak\r\nnext", "emoji 😀😃 x", "İstanbul", "a b c", "ÄÖÜß",
         "UPPER and lower", "१२३ devanagari"]


def test_trigrams_equal_brute_force(spark):
    got = apply(spark, TEXTS, X.trigrams)
    assert [set(g) for g in got] == [windows(t) for t in TEXTS]
    assert all(len(g) == len(set(g)) for g in got)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.text(alphabet=hs.characters(codec="utf-8", exclude_categories=["Cs", "Lu", "Lt"]), max_size=12), min_size=1, max_size=8))
def test_gram_codes_are_one_to_one(spark, texts):
    got = apply(spark, texts, H.gram_codes)
    strings = apply(spark, texts, X.trigrams)
    for codes, grams in zip(got, strings):
        assert codes == sorted(ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in grams)


def test_null_text_stays_null(spark):
    assert apply(spark, [None], X.trigrams) == [None]


def test_masks_any_script(spark):
    assert apply(spark, ["a12b३४c", "2024-01-02"], X.mask_digits) == ["a<NUM>b<NUM>c", "<NUM>-<NUM>-<NUM>"]


def test_order_of_cleaning_matters(spark):
    text = "12STATE PROCUREMENT CELL34"
    assert apply(spark, [text], X.cleaner("strip_then_mask")) == ["<NUM>"]
    assert apply(spark, [text], X.cleaner("mask_then_strip")) == ["<NUM><NUM>"]


def test_phrases_are_case_sensitive_for_strip_only(spark):
    text = "x State Procurement Cell y"
    assert apply(spark, [text], X.cleaner("mask_then_strip")) == [text]
    assert apply(spark, [text, "no phrase 1", "a\nSTATE PROCUREMENT CELL\nb"], X.cleaner("greedy_block")) == ["", "no phrase <NUM>", ""]


def test_block_ends_at_blank_line_or_span(spark):
    head = "NATIONAL PROCUREMENT AGGREGATION SERVICE"
    texts = [f"{head} legal words\n\nThe tender", head + "x" * 2000, f"{head} short"]
    strip = lambda c: X.strip_blocks(c)
    assert apply(spark, texts, strip) == ["The tender", "x" * 2000, " short"]
    assert apply(spark, ["body\nDISCLAIMER: none\nmore"], lambda c: X.strip_blocks(c, footers=["disclaimer"])) == ["body\n"]


@pytest.mark.parametrize(
    "form",
    ["Rs. 4,50,00,000/-", "Rs. 450.00 lakh", "INR 4.500 Cr", "45000000", "RUPEES 4,50,00,000 ONLY",
     "01-02-2024", "01/02/2024", "01.02.2024", "2024-02-01", "12 Mar 2024", "Mar 12, 2024", "12-Mar-24",
     "NPAS-2024-0001234", "SPC/2024-25/004512", "PWD/2024/00871", "00048213", "ref-2024-00912", "MC/2025/W/00311", "TN-000412/2024"],
)
def test_every_form_becomes_one_mask(spark, form):
    assert apply(spark, [f"of {form} for"], X.mask_typed) == ["of <NUM> for"]


def test_typed_tokens_and_punctuation(spark):
    got = apply(spark, ["due 12 Mar 2024: Rs. 5,000/-"], lambda c: X.mask_typed(c, date="<D>", amount="<M>"))
    assert got == ["due <D>: <M>"]
    assert apply(spark, ["a.b,c!d(é)"], X.strip_punctuation) == ["abcdé"]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        X.cleaner("other")


def test_clean_equals_plain_python(spark):
    def plain(text):
        text = re.sub(r"\d+", "<NUM>", text)
        for phrase in X.PHRASES:
            text = text.replace(phrase, "")
        return text

    texts = [*TEXTS, "ref 12 STATE PROCUREMENT CELL of NATIONAL PROCUREMENT AGGREGATION SERVICE 9"]
    assert apply(spark, texts, X.cleaner("mask_then_strip")) == [plain(t) for t in texts]
