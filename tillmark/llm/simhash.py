"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

Every 23-bit word has one codeword of the Golay code within 3 bits. If it lies at 3 bits,
five more codewords lie at 4. Two words that differ in one bit at most share one of these
codewords: either both are nearest to the same, or one is at 3 bits from its codeword and
the other, a step further away, at 4. A fingerprint of 64 bits has three segments; with
three differing bits in all, two segments at least differ in one bit or none. So close
fingerprints share, for one pair of segments, a pair of codeword indices: the join key.
Fingerprints that meet in a key are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmark.llm.common import Batches, map_batches, table, unused, words
from tillmark.llm.components import components
from tillmark.staging import stage

#: Fixed value: generator polynomial of the code, degree 11.
GENERATOR = 0b110001110101
#: Segments of a fingerprint: first bit and length; each is filled up with zeros to 23 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: More differing bits than this and the keys would no longer be certain to meet.
MOST = 3
_SLICE = 1 << 16


def fingerprint(text: str | None, length: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the ``length``-word shingles, A-Z in lower case; 0 without words.

    A text with fewer words is one shingle. Each occurrence of a shingle votes; a bit is set
    if more than half of the votes set it.
    """
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found).lower()
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(found) - length + 1)
    last = (ends[length - 1 :] if len(found) >= length else ends[-1:]) - 1
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        spans = zip(starts[at : min(n, at + _SLICE)].tolist(), last[at : min(n, at + _SLICE)].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((votes * 2 > n).astype(np.uint8), bitorder="little").view("<u8")[0])


@cache
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error, and the codewords of weight 7 that hold an error of weight 3; syndromes of 23 single bits."""
    single = np.zeros(23, np.int64)
    for bit in range(23):
        rest = 1 << bit
        for top in range(22, 10, -1):
            if rest >> top & 1:
                rest ^= GENERATOR << (top - 11)
        single[bit] = rest
    patterns = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)]
    errors = np.zeros(2048, np.int64)
    errors[syndromes(np.array(patterns), single)] = patterns
    every = np.arange(1 << 12) << 11
    codewords = every ^ syndromes(every, single)
    heavy = codewords[np.bitwise_count(codewords) == 7]
    extra = np.zeros((2048, 5), np.int64)
    for s in np.flatnonzero(np.bitwise_count(errors) == 3).tolist():
        extra[s] = heavy[(heavy & errors[s]) == errors[s]]
    return errors, extra, single


def syndromes(found: np.ndarray, single: np.ndarray) -> np.ndarray:
    out = np.zeros(len(found), np.int64)
    for bit in range(23):
        out ^= np.where(found >> bit & 1, single[bit], 0)
    return out


def indices(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six 12-bit codeword indices of each 23-bit word, and which of them count."""
    errors, extra, single = _code()
    at = syndromes(found, single)
    near = found ^ errors[at]
    far = np.bitwise_count(errors[at]) == 3
    rows = np.column_stack([near, near[:, None] ^ extra[at]]) >> 11
    return rows, np.column_stack([np.ones(len(found), bool), np.repeat(far[:, None], 5, axis=1)])


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of unsigned fingerprints, and the row each key comes from."""
    parts = [indices(((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64)) for a, n in SEGMENTS]
    out, rows = [], []
    for number, ((i, counts_i), (j, counts_j)) in enumerate(combinations(parts, 2)):
        for p in range(6):
            for q in range(6):
                both = np.flatnonzero(counts_i[:, p] & counts_j[:, q])
                out.append((number << 24) | (i[both, p] << 12) | j[both, q])
                rows.append(both)
    return np.concatenate(out), np.concatenate(rows)


def _forest(prints: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Links that join the fingerprints of one key within ``bits``: each reached one has one link."""
    a, b = [], []
    open_ = np.ones(len(prints), bool)
    for seed in range(len(prints)):
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue:
            own = queue.pop()
            rest = np.flatnonzero(open_)
            near = rest[np.bitwise_count(prints[rest] ^ prints[own]) <= bits]
            open_[near] = False
            queue += near.tolist()
            a += [own] * len(near)
            b += near.tolist()
    return a, b


def _meet(batches: Batches, bits: int, hot: int | None = None) -> Iterator[dict]:
    """Links among rows sorted by key; a key's rows may reach over batches.

    The rows of a key that has more than ``hot`` and goes on over batches are handed on instead, in
    numbered blocks of ``hot`` (``a`` is the fingerprint, ``block`` its number): no task holds such a key.
    """
    none = np.zeros(0, np.int64)
    kept_key, kept = none, none
    passed, sent = -1, 0  # the key that is handed on, and how many of its rows have been

    def links(key: np.ndarray, prints: np.ndarray) -> dict:
        found = prints.view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        pair = starts[sizes == 2]
        pair = pair[np.bitwise_count(found[pair] ^ found[pair + 1]) <= bits]
        a, b = [found[pair]], [found[pair + 1]]
        for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = found[at : at + n]
            i, j = _forest(own, bits)
            if i:
                a.append(own[i])
                b.append(own[j])
        one = np.concatenate(a).view(np.int64)
        return {"a": one, "b": np.concatenate(b).view(np.int64), "key": np.zeros(len(one), np.int64), "block": np.full(len(one), -1)}

    def later(key: int, prints: np.ndarray, before: int) -> dict:
        blocks = (before + np.arange(len(prints))) // hot
        return {"a": prints, "b": prints, "key": np.full(len(prints), key), "block": blocks}

    for batch in batches:
        key, prints = batch.column("key").to_numpy(), batch.column("print").to_numpy()
        if sent:
            cut = int(np.searchsorted(key, passed, "right"))
            if cut:
                yield later(passed, prints[:cut], sent)
                sent += cut
            key, prints = key[cut:], prints[cut:]
            if len(key):
                sent = 0
        key, prints = np.concatenate([kept_key, key]), np.concatenate([kept, prints])
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))  # the last key may go on
        kept_key, kept = key[cut:], prints[cut:]
        if cut:
            yield links(key[:cut], prints[:cut])
        if hot and len(kept) > hot:
            passed, sent = int(kept_key[0]), len(kept)
            yield later(passed, kept, 0)
            kept_key, kept = none, none
    if len(kept_key):
        yield links(kept_key, kept)


def fingerprints(docs: DataFrame, length: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text_hash, print`` of every row and its whole text; ``print`` is the fingerprint as a signed long."""
    slim = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def work(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            prints = np.array([fingerprint(t, length) for t in batch.column("text").to_pylist()], np.uint64)
            yield {"key": batch.column("key"), "text_hash": batch.column("text_hash"), "print": prints.view(np.int64)}

    return map_batches(slim, work, f"key {kind}, text_hash long, print long")


def links(prints: DataFrame, bits: int = MOST, hot: int = 4096) -> DataFrame:
    """``a, b``: links among distinct fingerprints (column ``print``), enough to connect all that lie within ``bits`` (an action).

    A task compares the fingerprints of its keys as they arrive. What it cannot hold, a key of more
    than ``hot`` that fills batches, is dealt in blocks of ``hot`` into squares of two blocks, so any
    two meet in one square and no task holds more than two blocks of it.
    """
    if not 0 <= bits <= MOST:
        raise ValueError(f"the keys hold for 0 to {MOST} bits")

    def spread(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            own = batch.column("print").to_numpy()
            for at in range(0, len(own), 2048):
                key, row = keys(own[at : at + 2048].view(np.uint64))
                yield {"key": key, "print": own[at : at + 2048][row]}

    keyed = map_batches(prints.select("print"), spread, "key long, print long")
    kind = "a long, b long, key long, block long"

    def meet(rows: DataFrame, hot: int | None) -> DataFrame:
        return map_batches(rows.repartition("key").sortWithinPartitions("key", "print"), lambda batches: _meet(batches, bits, hot), kind)

    met = stage(meet(keyed, hot), "met")
    found, late = met.where("block < 0").select("a", "b"), met.where("block >= 0").select("key", "block", F.col("a").alias("print"))
    if not late.isEmpty():
        last = late.groupBy("key").agg(F.max("block").alias("last"))
        dealt = late.join(last, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).where("other <> block")
        square = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
        found = found.union(meet(dealt.select(square.alias("key"), "print"), None).select("a", "b"))
    return found.distinct()


def near_duplicates(
    docs: DataFrame, length: int = 3, bits: int = MOST, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, text_hash, print, component, label`` of every row (an action).

    ``component`` is the smallest key among the rows that links reach, the row's own included;
    ``label`` names the group and is never NULL. Equal fingerprints are folded before the join,
    so copies cost nothing, and a key's fingerprints give a forest instead of all pairs; the
    fingerprints of a hot key are compared in blocks, in many tasks. Texts
    without words, NULL among them, have fingerprint 0 and link like others. Rows with a NULL
    key belong to groups but never name one; a group of such rows has a NULL component. Repeated
    rows stay as many as they are, an empty table gives none. Other columns are not read.
    """
    rows = stage(fingerprints(docs, length, key, text), "prints")
    folded = stage(rows.groupBy("print").agg(F.min("key").alias("low")), "folded")
    labels = components(links(folded, bits)).withColumnRenamed("node", "print")
    named = folded.join(labels, "print", "left").select("print", "low", F.coalesce("label", "print").alias("label"))
    groups = named.groupBy("label").agg(F.min("low").alias("component"))
    of = named.select("print", "label").join(groups, "label")
    return rows.join(of, "print").select("key", "text_hash", "print", "component", "label")


def hex_print(column: str = "print") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, length: int = 3, bits: int = MOST) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of smallest doc_id, then text hash (an action)."""
    own = unused(docs.columns)
    found = near_duplicates(docs, length, bits)
    order = F.struct(F.col("key").isNull().alias("none"), "key", "text_hash")
    first = found.groupBy("label").agg(F.min(order).alias("first")).select("first.key", "first.text_hash").distinct()
    chosen = stage(first, "kept").select(F.col("key").alias(f"{own}key"), F.col("text_hash").alias(f"{own}hash"))
    held = docs.withColumn(f"{own}text_hash", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").eqNullSafe(F.col(f"{own}key")) & (F.col(f"{own}text_hash") == F.col(f"{own}hash"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return held.join(chosen, same, "left_semi").dropDuplicates(["doc_id", f"{own}text_hash"]).select(*names)


def op3_golay_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("key").alias("doc_id"), hex_print().alias("fingerprint"), F.col("component").alias("component_id"))
