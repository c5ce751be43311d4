"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a text is the logistic of a bias, linear weights and all pairwise interactions
of its features, whose weights are inner products of short vectors. Their sum takes time
linear in the features: half of (sum of v x) squared less the sum of (v x) squared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmark.llm.common import Batches, map_batches, table, words
from tillmark.llm.quality_rules import BLANK, CLASSES, class_counts


@dataclass(frozen=True)
class Machine:
    """``sample`` bounds the labelled rows it is fitted on; words hash into ``2 ** bits`` features of ``rank`` factors."""

    sample: int = 6000
    bits: int = 15
    rank: int = 8
    rounds: int = 8
    batch: int = 64
    rate: float = 0.1
    decay: float = 1e-5
    seed: int = 7


#: Structure statistics: shares that are cut into ten levels each.
STATISTICS = (*[f"share_{c}" for c in CLASSES], "distinct_words", "long_words", "short_words", "marked_words", "common_word", "lines", "same_next")
LEVELS = 12
_LENGTHS = 24


def statistics(text: str, found: list[bytes]) -> np.ndarray:
    """Shares between 0 and 1 that describe how a text is built; all 0 without words."""
    out = np.zeros(len(STATISTICS))
    if not found:
        return out
    classes = class_counts(text)
    n = len(found)
    out[: len(CLASSES)] = classes / max(1, classes.sum())
    lengths = np.fromiter(map(len, found), np.int64, n)
    hashed = np.fromiter(map(zlib.crc32, found), np.int64, n)
    _, counts = np.unique(hashed, return_counts=True)
    out[len(CLASSES) :] = (
        len(counts) / n,
        (lengths > 12).mean(),
        (lengths < 3).mean(),
        classes[5:7].sum() / max(1, classes.sum() - classes[BLANK]),
        counts.max() / n,
        min(1.0, text.count("\n") / n),
        (hashed[1:] == hashed[:-1]).mean() if n > 1 else 0.0,
    )
    return out


def features(text: str | None, n_chars: int | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features; every text, also an empty one, has some.

    Words are weighed by the logarithm of their count and scaled to length 1. Each statistic
    and the magnitude of ``n_chars`` (metadata; NULL is a level of its own) is one feature.
    """
    text = text or ""
    found = words(text)
    size = 1 << bits
    hashed = np.fromiter(map(zlib.crc32, found), np.int64, len(found)) & (size - 1)
    index, counts = np.unique(hashed, return_counts=True)
    value = 1 + np.log(counts)
    if len(index):
        value /= np.sqrt((value * value).sum())
    level = np.minimum(LEVELS - 1, np.sqrt(statistics(text, found)) * LEVELS).astype(np.int64)
    at = size + np.arange(len(level)) * LEVELS + level
    length = _LENGTHS - 1 if n_chars is None else min(_LENGTHS - 2, max(0, int(n_chars)).bit_length())
    rest = np.append(at, [size + len(STATISTICS) * LEVELS + length, size + len(STATISTICS) * LEVELS + _LENGTHS + (not found)])
    return np.concatenate([index, rest]), np.concatenate([value, np.full(len(rest), 0.3)])


def width(bits: int) -> int:
    return (1 << bits) + len(STATISTICS) * LEVELS + _LENGTHS + 2


@dataclass
class Weights:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        spread = self.factors[index] * value[:, None]
        total = spread.sum(axis=0)
        pairs = 0.5 * float((total * total).sum() - (spread * spread).sum())
        return self.bias + float(self.linear[index] @ value) + pairs

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(index, value), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, machine: Machine) -> Weights:
    """Logistic loss, AdaGrad over small batches; classes weigh the same in total."""
    rng = np.random.default_rng(machine.seed)
    d, k = width(machine.bits), machine.rank
    bias, linear, factors = 0.0, np.zeros(d), rng.normal(0, 0.05, (d, k))
    seen_b, seen_l, seen_f = 1e-8, np.full(d, 1e-8), np.full((d, k), 1e-8)
    if not len(rows):
        return Weights(0.0, linear, np.zeros((d, k)))
    share = max(1, labels.sum()) / len(labels)
    weigh = np.where(labels > 0, 0.5 / share, 0.5 / max(1 / len(labels), 1 - share))
    for _ in range(machine.rounds):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), machine.batch):
            own = order[at : at + machine.batch]
            sizes = np.array([len(rows[i][0]) for i in own])
            index = np.concatenate([rows[i][0] for i in own])
            value = np.concatenate([rows[i][1] for i in own])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            spread = factors[index] * value[:, None]
            total = np.add.reduceat(spread, starts, axis=0)
            raw = bias + np.add.reduceat(linear[index] * value, starts) + 0.5 * (
                (total * total).sum(axis=1) - np.add.reduceat((spread * spread).sum(axis=1), starts)
            )
            gap = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[own]) * weigh[own] / len(own)
            each = np.repeat(gap, sizes)
            used, back = np.unique(index, return_inverse=True)
            step_l = np.bincount(back, each * value, len(used)) + machine.decay * linear[used]
            towards = (each * value)[:, None] * (np.repeat(total, sizes, axis=0) - spread)
            step_f = np.stack([np.bincount(back, towards[:, f], len(used)) for f in range(k)], axis=1) + machine.decay * factors[used]
            seen_b += gap.sum() ** 2
            bias -= machine.rate * gap.sum() / np.sqrt(seen_b)
            seen_l[used] += step_l**2
            linear[used] -= machine.rate * step_l / np.sqrt(seen_l[used])
            seen_f[used] += step_f**2
            factors[used] -= machine.rate * step_f / np.sqrt(seen_f[used])
    return Weights(bias, linear, factors)


def fold_of(key: Column) -> Column:
    """crc32 of the key's text, modulo 5; fold 0 is held out. NULL counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def _inputs(docs: DataFrame) -> DataFrame:
    """What a score may depend on, beside the key: text and stored length."""
    return docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long").alias("size"))


def train(docs: DataFrame, labels: DataFrame, machine: Machine = Machine()) -> Weights:
    """Fit on at most ``machine.sample`` labelled rows outside fold 0 (an action).

    Rows are taken in the order of a hash of their key. Documents with two different labels,
    with a NULL label or without a row in ``docs`` are left out. Only sparse features of the
    sample reach the driver. Without any labelled row every score is 0.5.
    """
    clear = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("high"))
    chosen = clear.where((F.col("label") == F.col("high")) & (fold_of(F.col("doc_id")) != 0))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(machine.sample).select(F.col("doc_id").alias("own"), F.col("label").cast("int").alias("label"))
    inputs = _inputs(docs)
    met = inputs.join(F.broadcast(chosen), F.col("key") == F.col("own")).drop("key")

    def work(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            made = [features(t, n, machine.bits) for t, n in zip(batch.column("text").to_pylist(), batch.column("size").to_pylist(), strict=True)]
            yield {
                "own": batch.column("own"),
                "label": batch.column("label"),
                "at": [i.astype(np.int32) for i, _ in made],
                "value": [v.astype(np.float32) for _, v in made],
            }

    kind = docs.schema["doc_id"].dataType.simpleString()
    drawn = map_batches(met, work, f"own {kind}, label int, at array<int>, value array<float>")
    drawn = drawn.orderBy(F.xxhash64("own"), "own", F.xxhash64("at")).limit(machine.sample).toArrow()
    at, value = (drawn.column(c).combine_chunks() for c in ("at", "value"))
    ends = at.offsets.to_numpy()[1:-1] - at.offsets.to_numpy()[0] if len(at) else []
    rows = list(zip(np.split(at.flatten().to_numpy(), ends), np.split(value.flatten().to_numpy().astype(float), ends), strict=True)) if len(at) else []
    return fit(rows, drawn.column("label").to_numpy().astype(float), machine)


def score(docs: DataFrame, weights: Weights, machine: Machine = Machine(), threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row and its whole text, one pass without shuffle.

    NULL and empty texts are scored by their structure and metadata. Repeated rows get the same
    score; an empty table gives no rows. No other column is read.
    """
    inputs = _inputs(docs).withColumn("held_out", fold_of(F.col("key")) == 0)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            made = [weights.score(*features(t, n, machine.bits)) for t, n in zip(batch.column("text").to_pylist(), batch.column("size").to_pylist(), strict=True)]
            yield {"doc_id": batch.column("key"), "held_out": batch.column("held_out"), "score": made, "predicted": [int(x >= threshold) for x in made]}

    return map_batches(inputs, work, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op5_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, train(docs, table(spark, folder, "labels")))
