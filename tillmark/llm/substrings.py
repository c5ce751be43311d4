"""Exact removal of passages that repeat across documents, by super-k-mer partitioning.

A window is ``k`` consecutive words of one document. Its minimiser is the smallest hash among
its runs of ``m`` words. Consecutive windows with one minimiser form a super-k-mer. Equal
windows have equal minimisers, so a minimiser that occurs in one document only needs no
further work, and all other super-k-mers travel as one packed string to the bucket of their
minimiser. There, rows sorted by document tell for each window, compared word for word, the
first document that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmark.llm.common import Batches, map_batches, table, words
from tillmark.staging import stage

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PART = 1 << 18


@dataclass(frozen=True)
class Shape:
    """``k`` words a window, ``m`` words a minimiser; ``hot``: super-k-mers from which on a bucket is split by window."""

    k: int = 50
    m: int = 8
    hot: int = 4000

    def __post_init__(self):
        if not 1 <= self.m <= self.k or self.hot < 1:
            raise ValueError("1 <= m <= k and hot >= 1")


def minimisers(found: list[bytes], shape: Shape) -> np.ndarray:
    """Minimiser of each window."""
    digest = xxhash.xxh3_64_intdigest
    known: dict[bytes, int] = {}
    for w in set(found):
        known[w] = digest(w)
    hashed = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    runs = len(found) - shape.m + 1
    mixed = hashed[:runs].copy()
    for i in range(1, shape.m):
        mixed = mixed * _MIX + hashed[i : i + runs]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    width, reach = shape.k - shape.m + 1, 1
    low = mixed
    while reach * 2 <= width:  # minima of doubling spans
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if rest := width - reach:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return low


def super_kmers(found: list[bytes], shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Minimiser, first window and number of windows of each super-k-mer; long texts in parts."""
    windows = len(found) - shape.k + 1
    for at in range(0, max(0, windows), _PART):
        low = minimisers(found[at : min(windows, at + _PART) + shape.k - 1], shape)
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        yield low[starts].view(np.int64), starts + at, np.diff(np.append(starts, len(low)))


def _survey(batches: Batches, shape: Shape) -> Iterator[dict]:
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("key", "text_hash", "minimiser", "start", "n")}
        columns = (batch.column(c).to_pylist() for c in ("key", "text_hash", "text"))
        for key, text_hash, text in zip(*columns, strict=True):
            for low, start, n in super_kmers(words(text), shape):
                out["key"] += [key] * len(low)
                out["text_hash"] += [text_hash] * len(low)
                out["minimiser"].append(low)
                out["start"].append(start)
                out["n"].append(n)
        if out["key"]:
            yield out | {c: np.concatenate(out[c]) for c in ("minimiser", "start", "n")}


def _cut(batches: Batches, shape: Shape) -> Iterator[dict]:
    """Packed strings of the super-k-mers asked for; those of hot buckets window by window."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("bucket", "key", "text_hash", "start", "packed")}
        size = 0
        for key, text_hash, text, asked in zip(*(batch.column(c).to_pylist() for c in ("key", "text_hash", "text", "asked")), strict=True):
            found = words(text)
            for x in asked:
                step = 1 if x["hot"] else x["n"]
                for start in range(x["start"], x["start"] + x["n"], step):
                    packed = b" ".join(found[start : start + step + shape.k - 1])
                    out["bucket"].append(xxhash.xxh3_64_intdigest(packed) - (1 << 63) if x["hot"] else x["minimiser"])
                    out["key"].append(key)
                    out["text_hash"].append(text_hash)
                    out["start"].append(start)
                    out["packed"].append(packed)
                    size += len(packed)
                if size > 1 << 24:
                    yield out
                    out, size = {c: [] for c in out}, 0
        yield out


def _windows(packed: bytes, k: int) -> list[bytes]:
    ends = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    ends = [*ends.tolist(), len(packed)]
    return [packed[a:b] for a, b in zip(starts, ends[k - 1 :], strict=False)]


def _spans(marked: list[bool], start: int, k: int) -> list[tuple[int, int]]:
    """Word ranges covered by the marked ones of consecutive windows."""
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(marked).tolist():
        if out and start + i <= out[-1][1]:
            out[-1] = (out[-1][0], start + i + k)
        else:
            out.append((start + i, start + i + k))
    return out


def _compare(batches: Batches, k: int) -> Iterator[dict]:
    """Ranges to remove, from rows sorted by bucket and document; one bucket's windows are held at a time."""
    bucket, first, done = None, {}, {}
    for batch in batches:
        out: dict[str, list] = {"own": [], "own_hash": [], "spans": []}
        columns = (batch.column(c).to_pylist() for c in ("bucket", "key", "text_hash", "start", "packed"))
        for own, key, text_hash, start, packed in zip(*columns, strict=True):
            if own != bucket:
                bucket, first, done = own, {}, {}
            # A string seen in an earlier document has all its windows there.
            if done.setdefault(packed, key) != key:
                n = packed.count(b" ") + 2 - k
                marked = [True] * n
            else:
                marked = [first.setdefault(w, key) != key for w in _windows(packed, k)]
            if spans := _spans(marked, start, k):
                out["own"].append(key)
                out["own_hash"].append(text_hash)
                out["spans"].append([{"start": a, "stop": b} for a, b in spans])
        yield out


_SPANS = "array<struct<start:int,stop:int>>"


def _base(docs: DataFrame, carry: Sequence[str], key: str, text: str) -> tuple[DataFrame, str]:
    """``key, text_hash, text`` and the carried columns under numbers, so that no name can clash; their types."""
    body = F.col(f"`{text}`").cast("string")
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry) if c != text]
    base = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("text_hash"), body.alias("text"), *kept)
    return base, base.schema["key"].dataType.simpleString()


def _spans_of(base: DataFrame, kind: str, shape: Shape) -> DataFrame:
    """``own, own_hash, spans`` for the rows of ``_base``; see ``repeated_spans`` (an action)."""
    survey = map_batches(
        base.select("key", "text_hash", "text"),
        lambda batches: _survey(batches, shape),
        f"key {kind}, text_hash long, minimiser long, start int, n int",
    )
    shared = (
        survey.groupBy("minimiser").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("rows"))
        .where(F.col("low") < F.col("high")).select("minimiser", (F.col("rows") > shape.hot).alias("hot"))
    )
    asked = stage(
        survey.join(shared, "minimiser").groupBy("key", "text_hash")
        .agg(F.collect_set(F.struct("start", "n", "minimiser", "hot")).alias("asked"))
        .withColumnsRenamed({"key": "own", "text_hash": "own_hash"}),
        "asked",
    )

    def cut(hot: bool) -> DataFrame:
        part = asked.withColumn("asked", F.filter("asked", lambda x: x["hot"] == hot)).where(F.size("asked") > 0)
        met = base.join(part, (F.col("key") == F.col("own")) & (F.col("text_hash") == F.col("own_hash")))
        return map_batches(
            met, lambda batches: _cut(batches, shape), f"bucket long, key {kind}, text_hash long, start int, packed binary"
        )

    fields = f"own {kind}, own_hash long, spans {_SPANS}"
    met = cut(False).repartition("bucket").sortWithinPartitions("bucket", "key", "text_hash", "start")
    found = map_batches(met, lambda batches: _compare(batches, shape.k), fields)
    if not asked.where(F.exists("asked", lambda x: x["hot"])).isEmpty():
        windows = stage(cut(True).select("key", "text_hash", "start", "packed"), "windows")
        first = windows.groupBy("packed").agg(F.min("key").alias("first"))
        late = windows.join(first, "packed").where(F.col("key") > F.col("first"))
        span = F.struct(F.col("start").alias("start"), (F.col("start") + F.lit(shape.k)).alias("stop"))
        found = found.union(late.select("key", "text_hash", F.array(span).cast(_SPANS)))
    return found.groupBy("own", "own_hash").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def repeated_spans(docs: DataFrame, shape: Shape = Shape(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``own, own_hash, spans``: word ranges of each document covered by windows that start in a smaller one too (an action).

    Rows are named by key and text, so equal rows share one result. Rows of one key never
    remove from each other; rows with a NULL key neither remove nor lose anything. Only
    super-k-mers whose minimiser occurs in two documents move. In a bucket of more than
    ``shape.hot`` super-k-mers each window goes its own way: first documents are then found by
    an aggregation, which folds repeats before the shuffle, and a join, which splits skew.
    """
    base, kind = _base(docs, (), key, text)
    return _spans_of(base.where(F.col("key").isNotNull()), kind, shape)


def covered(n: int, spans: list | None) -> np.ndarray:
    """Which of n words lie in one of the ranges."""
    ends = np.zeros(n + 1, np.int64)
    for x in spans or ():
        ends[x["start"]] += 1
        ends[x["stop"]] -= 1
    return np.cumsum(ends)[:n] > 0


def deduplicate(
    docs: DataFrame, shape: Shape = Shape(), carry: Sequence[str] = ("doc_id",), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``carry`` columns, ``n_words``, ``n_removed`` and ``kept`` of every row (an action).

    ``kept`` holds the kept words joined by one space. Windows are judged on the input alone.
    NULL and empty texts have no words; texts shorter than a window keep all. Repeated rows
    stay as many as they are; an empty table gives none. Columns not in ``carry`` are not read.
    """
    base, kind = _base(docs, carry, key, text)
    named = base.where(F.col("key").isNotNull())
    spans = _spans_of(named, kind, shape)
    joined = named.join(spans, (F.col("key") == F.col("own")) & (F.col("text_hash") == F.col("own_hash")), "left")
    nameless = base.where(F.col("key").isNull()).withColumn("spans", F.lit(None).cast(_SPANS))
    columns = ["text", "spans", *[f"c{i}" for i, c in enumerate(carry) if c != text]]
    kinds = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)]

    def work(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: dict = {f"c{i}": batch.column("text" if c == text else f"c{i}") for i, c in enumerate(carry)}
            out |= {"n_words": [], "n_removed": [], "kept": []}
            for body, gaps in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                found = words(body)
                if gaps:
                    gone = covered(len(found), gaps).tolist()
                    kept = [w for w, x in zip(found, gone, strict=True) if not x]
                else:
                    kept = found
                out["n_words"].append(len(found))
                out["n_removed"].append(len(found) - len(kept))
                out["kept"].append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            yield out

    rows = joined.select(*columns).union(nameless.select(*columns))
    made = map_batches(rows, work, ", ".join([*kinds, "n_words long, n_removed long, kept string"]))
    return made.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})


def op4_super_kmers(spark: SparkSession, folder: str) -> DataFrame:
    made = deduplicate(table(spark, folder, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l
  FROM documents),
starts AS (SELECT doc_id, l, unnest(range(1, len(l) - 48)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(l[i : i + 49], ' ') AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS low FROM windows GROUP BY s),
late AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE doc_id > low),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM late),
listed AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
         CASE WHEN g IS NULL THEN l
              ELSE list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda x: NOT list_contains(g, x[2])), lambda x: x[1]) END AS k
  FROM w LEFT JOIN listed ON w.doc_id = listed.doc_id)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""
