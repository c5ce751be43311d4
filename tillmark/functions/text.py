"""Text cleaning and character trigrams, all inside JVM expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# The two preamble phrases that the aggregator portals paste.
PHRASES = ("NATIONAL PROCUREMENT AGGREGATION SERVICE", "STATE PROCUREMENT CELL")
# Openings of the footers that portals add.
FOOTERS = ("DISCLAIMER", "This is a system generated notice")
MASK = "<NUM>"

# Forms of money, dates and reference numbers seen in notices.
_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
REFERENCES = (
    r"\b[A-Za-z]{2,5}[-/]\d{4}(?:-\d{2})?[-/](?:[A-Z]/)?\d{4,7}\b",
    r"\b[A-Za-z]{2,5}-\d{6}/\d{4}\b",
    r"\b0\d{7}\b",
)
DATES = (
    r"\b\d{1,2}[-/.]\d{1,2}[-/.]\d{4}\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
    r"\b\d{1,2}[- ]" + _MONTH + r"[- ]\d{2,4}\b",
    r"\b" + _MONTH + r" \d{1,2}, \d{4}\b",
)
AMOUNTS = (
    r"(?i)\b(?:rs\.?|inr|rupees)\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:lakh|crore|cr|only)\b)?(?:/-)?",
    r"\b\d{7,}\b",
)


def mask_digits(text: Column) -> Column:
    """Every run of decimal digits of any script becomes one mask token."""
    return F.regexp_replace(text, r"\p{Nd}+", MASK)


def strip_phrases(text: Column, phrases: Sequence[str] = PHRASES) -> Column:
    for phrase in phrases:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    return text


def wipe_if_phrase(text: Column, phrases: Sequence[str] = PHRASES) -> Column:
    """A text that contains a phrase, in any case, is emptied as a whole."""
    for phrase in phrases:
        text = F.when(text.rlike("(?iu)" + _quoted(phrase)), F.lit("")).otherwise(text)
    return text


def strip_blocks(
    text: Column,
    phrases: Sequence[str] = PHRASES,
    span: int = 1400,
    footers: Sequence[str] = (),
) -> Column:
    """Remove the block a phrase opens, up to a blank line at most ``span`` characters on.

    Without one in reach only the phrase goes: what follows may be the tender itself.  Footer
    phrases open a block that runs to the end of the text.
    """
    for phrase in phrases:
        start = "(?is)" + _quoted(phrase)
        text = F.regexp_replace(text, f"{start}(?:.{{0,{span}}}?\\n[ \\t]*\\n)?", "")
    for phrase in footers:
        text = F.regexp_replace(text, "(?is)" + _quoted(phrase) + ".*", "")
    return text


def strip_punctuation(text: Column) -> Column:
    """Drop ASCII punctuation."""
    return F.regexp_replace(text, r"\p{Punct}", "")


def mask_typed(
    text: Column,
    reference: str = MASK,
    date: str = MASK,
    amount: str = MASK,
) -> Column:
    """Mask reference numbers, dates and amounts, in this order."""
    for patterns, token in ((REFERENCES, reference), (DATES, date), (AMOUNTS, amount)):
        for pattern in patterns:
            text = F.regexp_replace(text, pattern, token)
    return text


def cleaner(
    strategy: str, phrases: Sequence[str] = PHRASES, span: int = 1400, footers: Sequence[str] = FOOTERS
) -> Callable[[Column], Column]:
    """Cleaning by name.  Strip-then-mask and mask-then-strip differ on a phrase between digits."""
    known: dict[str, Callable[[Column], Column]] = {
        "raw": lambda c: c,
        "strip_then_mask": lambda c: mask_digits(strip_phrases(c, phrases)),
        "mask_then_strip": lambda c: strip_phrases(mask_digits(c), phrases),
        "greedy_block": lambda c: wipe_if_phrase(mask_digits(c), phrases),
        "block": lambda c: mask_digits(strip_blocks(c, phrases, span)),
        "block_and_footer": lambda c: mask_digits(strip_blocks(c, phrases, span, footers)),
        "typed": lambda c: strip_punctuation(mask_digits(mask_typed(strip_phrases(c, phrases)))),
    }
    if strategy not in known:
        raise ValueError(f"unknown strategy {strategy!r}, expected one of {sorted(known)}")
    return known[strategy]


def trigrams(text: Column) -> Column:
    """Distinct three-character windows of the lower-cased text, empty below three characters.

    The look-ahead captures three code points while the match itself consumes one, so
    the scan is linear and never starts inside a surrogate pair.
    """
    windows = F.regexp_extract_all(F.lower(text), F.lit(r"(?s)(?=(.{3}))."), F.lit(1))
    return F.array_distinct(windows)


def _quoted(phrase: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", phrase)
