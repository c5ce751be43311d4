"""Quality rules: base statistics of a text and its divergence from language references.

The references come from the corpus: for each language the mean, over its documents, of the
histogram of character classes and of the most common words. A document is compared with
that of its own language by Jensen-Shannon divergence (base 2, 0 to 1); where its language has
none, the nearest of all counts.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillmark.llm.common import Batches, each_batch, map_batches, table, words

CLASSES = ("blank", "lower", "upper", "letter", "number", "symbol", "punctuation", "other")
BLANK, LOWER, UPPER, LETTER, NUMBER, SYMBOL, PUNCTUATION, OTHER = range(len(CLASSES))
SYMBOLS = "#*$%&|<>"
_MARKS = b".,;:!?"


@dataclass(frozen=True)
class Limits:
    """Bounds of the verdict.

    The words of a text are judged from ``min_words`` words on, its characters from
    ``min_chars`` on: shorter ones say too little. A text of n words and c characters may
    diverge by the given value plus ``slack`` over its length, which pays for chance.

    Divergence says little about missing words: without any common word it stays below 0.21
    where these make up 0.36 of a language, lower where they are rarer. So a text has too few
    of them, whatever its divergence, if a text that draws ``scant`` times the reference's
    share had so few with a probability below ``chance`` (Chernoff bound, exact for none).
    """

    min_words: int = 40
    min_chars: int = 200
    word_divergence: float = 0.11
    char_divergence: float = 0.035
    word_slack: float = 10.0
    char_slack: float = 20.0
    scant: float = 0.5
    chance: float = 1e-3


@cache
def _class_of() -> np.ndarray:
    """Class of each code point: the six blanks and the eight symbols first, then by Unicode category."""
    kinds = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "Lm": LETTER, "Lo": LETTER}
    by_first = {"N": NUMBER, "P": PUNCTUATION}

    def kind(point: int) -> int:
        category = unicodedata.category(chr(point))
        return kinds.get(category, by_first.get(category[0], OTHER))

    out = np.fromiter(map(kind, range(0x110000)), np.uint8, 0x110000)
    out[[ord(c) for c in " \t\n\x0b\x0c\r"]] = BLANK
    out[[ord(c) for c in SYMBOLS]] = SYMBOL
    return out


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_class_of()[points], minlength=len(CLASSES))


def repeated_words(found: Sequence[bytes], width: int = 5) -> int:
    """Words inside a window of ``width`` words that occurs twice or more in the text.

    Windows of different hashes differ, so a text whose hashes are all distinct is done.
    Otherwise windows are numbered exactly: the number of a prefix and the next word give
    the number of the prefix longer by a word.
    """
    n = len(found) - width + 1
    if n < 2:
        return 0
    hashed = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    mixed = hashed[:n].copy()
    for k in range(1, width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + n]
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():
        return 0
    ids: dict[bytes, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in found], np.int64)
    same = code[:n]
    for k in range(1, width):
        same = np.unique(same * len(ids) + code[k : k + n], return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(same)[same] > 1)
    ends = np.zeros(len(found) + 1, np.int64)
    ends[starts] += 1
    ends[starts + width] -= 1
    return int((np.cumsum(ends)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _plain(word: bytes) -> bytes:
    """Lower case (A-Z), without one mark at the end."""
    return (word[:-1] if word[-1] in _MARKS else word).lower()


def _spellings(word: bytes) -> list[bytes]:
    return [x + m for x in {word, word.capitalize(), word.upper()} for m in [b"", *(bytes([c]) for c in _MARKS)]]


def references(docs: DataFrame, common: int = 60, least: int = 20) -> dict:
    """``{language: (class shares, {word: share})}`` over all documents and whole texts (an action).

    Counts are summed per batch before the shuffle. Every language of ``least`` documents or
    more gives a reference; each brings its class shares and its ``common`` most frequent words,
    of any length and script, to the driver, no more. Rarer languages, and documents without
    language or words, give none: their documents are compared with the references of the others.
    """

    def gather(batch: pa.RecordBatch) -> dict[str, list]:
        sums: Counter = Counter()
        held: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = words(text)
            if lang is None or not found:
                continue
            sums[lang, "documents", ""] += 1
            sums[lang, "words", ""] += len(found)
            for name, n in zip(CLASSES, class_counts(text).tolist(), strict=True):
                sums[lang, "class", name] += n
            held[lang].update(found)
        for lang, counts in held.items():
            for word, n in counts.items():
                if plain := _plain(word):
                    sums[lang, "word", plain.decode("utf-8", "replace")] += n
        keys = list(sums)
        return {"lang": [k[0] for k in keys], "kind": [k[1] for k in keys], "name": [k[2] for k in keys], "n": [sums[k] for k in keys]}

    slim = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    summed = each_batch(slim, gather, "lang string, kind string, name string, n long").groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))
    top = summed.withColumn("rank", rank).where(F.col("rank") <= F.lit(max(common, len(CLASSES))))
    size = F.max(F.when(F.col("kind") == "documents", F.col("n")))
    rows = top.groupBy("lang").agg(F.collect_list(F.struct("kind", "rank", "name", "n")).alias("rows"), size.alias("size"))
    out = {}
    for lang, held, _ in rows.where(F.col("size") >= least).orderBy(F.desc("size"), "lang").collect():
        classes = {r.name: r.n for r in held if r.kind == "class"}
        total = next(r.n for r in held if r.kind == "words")
        shares = np.array([classes.get(c, 0) for c in CLASSES], float)
        usual = sorted((r.rank, r.name.encode(), r.n / total) for r in held if r.kind == "word" and r.rank <= common)
        out[lang] = (shares / shares.sum(), {w: x for _, w, x in usual})
    return out


def _entropy(p: np.ndarray) -> np.ndarray:
    """Bits of each row."""
    return -(p * np.log2(p, out=np.zeros_like(p), where=p > 0)).sum(axis=-1)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2, 0 to 1) of the distributions in the rows of p and q."""
    return np.maximum(0.0, _entropy((p + q) / 2) - (_entropy(p) + _entropy(q)) / 2)


def _with_rest(p: np.ndarray) -> np.ndarray:
    return np.column_stack([p, np.maximum(0.0, 1 - p.sum(axis=1))])


class References:
    """The references as arrays: one row a language."""

    def __init__(self, known: dict):
        self.languages = list(known)
        self.number = {lang: i for i, lang in enumerate(self.languages)}
        place: dict[bytes, int] = {}
        self.spelled: dict[bytes, int] = {}
        for _, usual in known.values():
            for w in usual:
                place.setdefault(w, len(place))
        for w, i in place.items():
            self.spelled.update(dict.fromkeys(_spellings(w), i))
        self.spelled.update(place)
        width = max((len(u) for _, u in known.values()), default=0)
        self.words = np.zeros((len(known), width))
        self.places = np.full((len(known), width), len(place))  # the last place counts nothing
        for i, (_, usual) in enumerate(known.values()):
            self.words[i, : len(usual)] = list(usual.values())
            self.places[i, : len(usual)] = [place[w] for w in usual]
        self.classes = np.array([c for c, _ in known.values()]).reshape(len(known), len(CLASSES))
        self.usual = self.words.sum(axis=1)
        self.size = len(place)

    def apart(self, found: Sequence[bytes], classes: np.ndarray, lang: str | None = None) -> tuple[float, float, float, float]:
        """Divergence of the characters and of the words from the reference of ``lang`` or, if there is
        none, from that whose words are nearest, and the share of its common words in the text and in it."""
        places = np.fromiter(map(self.spelled.get, found, repeat(self.size)), np.int64, len(found))
        counts = np.bincount(places, minlength=self.size + 1)[: self.size + 1].astype(float)
        counts[self.size] = 0
        own = self.number.get(lang)
        some = slice(None) if own is None else slice(own, own + 1)
        by_words = divergence(_with_rest(counts[self.places[some]] / len(found)), _with_rest(self.words[some]))
        near = int(by_words.argmin())
        best = near if own is None else own
        chars = float(divergence(classes / classes.sum(), self.classes[best]))
        return chars, float(by_words[near]), float(counts[self.places[best]].sum() / len(found)), float(self.usual[best])


def too_few(n: int, share: float, usual: float, limits: Limits) -> bool:
    """Whether ``share`` common words among ``n`` are fewer than chance leaves at ``scant * usual``."""
    least = limits.scant * usual
    if share >= least:
        return False
    apart = (1 - share) * math.log((1 - share) / (1 - least)) + (share * math.log(share / least) if share else 0.0)
    return n * apart > -math.log(limits.chance)


STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, char_divergence double, word_divergence double"
)


def judge(text: str | None, lang: str | None, known: References, limits: Limits = Limits()) -> tuple:
    """The columns ``STATISTICS`` of one text; no text counts as an empty one.

    The reference of ``lang`` counts, so a text in another language than its tag fails. Without one,
    the tag being NULL, rare or mistyped, the nearest of all counts: such a tag exempts nothing.
    """
    text = text or ""
    found = words(text)
    n, classes, again = len(found), class_counts(text), repeated_words(found)
    failed = n < 10 or 100 * again > 20 * n
    chars = apart = None
    kept = not failed
    if n and known.languages:
        chars, apart, share, usual = known.apart(found, classes, lang)
        if n >= limits.min_words and too_few(n, share, usual, limits):
            kept = False
        if n >= limits.min_words and apart > limits.word_divergence + limits.word_slack / n:
            kept = False
        if len(text) >= limits.min_chars and chars > limits.char_divergence + limits.char_slack / len(text):
            kept = False
    return (n, len(text) - int(classes[BLANK]), int(classes[SYMBOL]), duplicate_lines(text), again, failed, kept, chars, apart)


def quality(docs: DataFrame, known: dict, limits: Limits = Limits(), carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``STATISTICS`` of every row, one pass over the whole texts without shuffle.

    NULL and empty texts have no words and fail. Texts are judged by the reference of their
    language, texts of a language without one, or of none, by the nearest; the base rules decide alone only where ``known`` is empty. ``carry``
    may name any columns but those in ``STATISTICS``; equal rows stay as many as they are.
    """
    names = [f.split()[0] for f in STATISTICS.split(", ")]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    slim = docs.select(
        *[F.col(f"`{c}`") for c in carry if c != "text"],
        F.col("text").cast("string").alias("__text"),
        F.col("lang").cast("string").alias("__lang"),
    )

    def work(batches: Batches) -> Iterator[dict]:
        held = References(known)
        for batch in batches:
            pairs = zip(batch.column("__text").to_pylist(), batch.column("__lang").to_pylist(), strict=True)
            if rows := [judge(text, lang, held, limits) for text, lang in pairs]:
                kept = {c: batch.column("__text" if c == "text" else c) for c in carry}
                yield kept | dict(zip(names, zip(*rows, strict=True), strict=True))

    return map_batches(slim, work, f"{kinds}, {STATISTICS}")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality(docs, references(docs))
