"""Nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised on their own; a cell is a pair of centroids. A query
visits cells in the order of their summed distance, taken from a heap over the two sorted
lists of centroids, until the cells hold enough entries; these are ranked exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillmark.llm.common import Batches, map_batches, shipped, table
from tillmark.staging import stage


@dataclass(frozen=True)
class Index:
    """``centroids`` a half, fitted on at most ``sample`` distinct vectors in ``rounds`` rounds.

    A query visits cells that hold ``share`` of all distinct vectors, ``least`` at least. The
    share, not a number, is what keeps recall alike at every size; well-clustered vectors need
    less. A task compares ``block`` entries with ``queries`` queries at a time.
    """

    centroids: int = 16
    sample: int = 16384
    rounds: int = 12
    share: float = 0.7
    least: int = 1000
    block: int = 4096
    queries: int = 8192


def quantise(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Nearest centroid of each vector."""
    return ((centroids * centroids).sum(axis=1) - 2 * vectors @ centroids.T).argmin(axis=1)


def fit(vectors: np.ndarray, centroids: int, rounds: int) -> np.ndarray:
    """Centroids by Lloyd's method from evenly spaced starts; no more than there are vectors."""
    found = vectors[np.linspace(0, len(vectors) - 1, min(centroids, len(vectors))).astype(int)].copy()
    for _ in range(rounds):
        of = quantise(vectors, found)
        for i in range(len(found)):
            if (own := of == i).any():
                found[i] = vectors[own].mean(axis=0)
    return found


def cells_by_distance(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by ascending ``first[i] + second[j]``, from a heap that holds one open pair a row."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last: one value whatever the block."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def best_of(queries: np.ndarray, open_: np.ndarray, entries: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Rows of queries and entries and the inner product of the k best open entries of each query.

    A product of matrices finds all that can be among them; the exact sums decide. Equal sums
    go to the smaller ``low``.
    """
    rows, cols = [], []
    for at in range(0, len(queries), 256):
        own = queries[at : at + 256]
        rough = np.where(open_[at : at + 256], own @ entries.T, -np.inf)
        if rough.shape[1] > k:
            edge = np.partition(rough, -k, axis=1)[:, -k]
        else:
            edge = np.full(len(own), -np.inf)
        sizes = np.sqrt((own * own).sum(axis=1)) * np.sqrt((entries * entries).sum(axis=1).max())
        i, j = np.nonzero((rough >= (edge - 1e-9 * sizes)[:, None]) & (rough > -np.inf))
        rows.append(i + at)
        cols.append(j)
    row, col = np.concatenate(rows), np.concatenate(cols)
    score = _inner(queries[row], entries[col])
    order = np.lexsort((low[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], col[rank < k], score[rank < k]


def distinct_vectors(vectors: DataFrame, size: int, keep: int) -> DataFrame:
    """``vector, ids``: each distinct vector of ``size`` components with its ``keep`` smallest ids, sorted.

    ``row_number`` cuts the ids of a very common vector before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = vectors.where(F.size("vector") == size).distinct().withColumn("rank", rank).where(F.col("rank") <= keep)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    found = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return found.where(F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def nearest(
    df: DataFrame, every: int = 20, k: int = 20, index: Index = Index(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest found of each row whose id ``every`` divides: ``query_id, rank, vec_id, score`` (an action).

    Nearness is the largest inner product, in double precision on the original vectors; ties go
    to the smaller id. Rows take no part if id or vector is NULL, the vector is empty, zero or
    holds NULL or non-finite components, or its length is not the most common one (of equally
    common ones the smaller). Equal rows count once. Equal vectors are one entry with its k + 1
    smallest ids - no result can need more - and one search, whatever their number. Candidates
    are all rows but those of the query's own id. An empty table gives no rows.
    """
    spark = df.sparkSession
    vectors = usable(df, key, vector)
    schema = "query_id long, rank int, vec_id long, score double"
    length = vectors.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if length is None:
        return spark.createDataFrame([], schema)
    folded = stage(
        distinct_vectors(vectors, length["size"], k + 1).withColumn("entry", F.monotonically_increasing_id()), "vectors"
    )
    asked = vectors.where((F.col("id") % every == 0) & (F.size("vector") == length["size"])).distinct()
    asked = stage(asked.join(folded.select("vector", "entry"), "vector").select(F.col("id").alias("query_id"), "entry"), "asked")

    drawn = folded.orderBy(F.xxhash64("vector"), "entry").limit(index.sample).select("vector").toArrow()
    sample = _matrix(drawn.column("vector"))
    half = max(1, length["size"] // 2)
    books = [fit(part, index.centroids, index.rounds) if part.shape[1] else np.zeros((1, 0)) for part in (sample[:, :half], sample[:, half:])]

    def place(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            own = _matrix(batch.column("vector"))
            if len(own):
                c1, c2 = quantise(own[:, :half], books[0]), quantise(own[:, half:], books[1])
                yield {c: batch.column(c) for c in ("entry", "vector", "low")} | {"shelf": c1, "cell": c2}

    low = folded.select("entry", "vector", F.element_at("ids", 1).alias("low"))
    entries = stage(map_batches(low, place, "entry long, vector array<double>, low long, shelf int, cell int"), "entries")
    held = np.zeros((len(books[0]), len(books[1])), np.int64)  # bounded by the number of cells
    for row in entries.groupBy("shelf", "cell").count().collect():
        held[row["shelf"], row["cell"]] = row["count"]
    wanted = max(index.least, int(np.ceil(index.share * held.sum())))
    blocks = np.maximum(1, -(-held.sum(axis=1) // index.block))

    searches = folded.join(asked.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")
    groups = max(1, -(-searches.count() // index.queries))

    def route(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("shelf", "block", "query", "asks", "cells")}
            own = _matrix(batch.column("vector")) if batch.num_rows else np.zeros((0, half))
            near = -own[:, :half] @ books[0].T, -own[:, half:] @ books[1].T
            for entry, vec, first, second in zip(batch.column("entry").to_pylist(), own, *near, strict=True):
                seen, visits = 0, {}
                for i, j in cells_by_distance(first, second):
                    if held[i, j]:
                        visits.setdefault(i, []).append(j)
                        seen += held[i, j]
                        if seen >= wanted:
                            break
                for shelf, cells in visits.items():
                    for block in range(blocks[shelf]):
                        for c, v in zip(out, (shelf, block, entry, vec, cells), strict=True):
                            out[c].append(v)
            yield out

    probes = map_batches(searches, route, "shelf int, block int, query long, asks array<double>, cells array<int>")
    probes = probes.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int"))
    per_shelf = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("shelf") + 1)
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("entry"), per_shelf).cast("int"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = len(books[1])

    def compare(_: tuple, asks: pa.Table, shelf: pa.Table) -> pa.Table:
        if not asks.num_rows or not shelf.num_rows:
            return pa.table({"query": pa.array([], "int64"), "entry": pa.array([], "int64"), "low": pa.array([], "int64"), "score": pa.array([], "float64")})
        visited = np.zeros((asks.num_rows, names), bool)
        cells = asks.column("cells").combine_chunks()
        visited[np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy())), cells.flatten().to_numpy()] = True
        low = shelf.column("low").to_numpy()
        row, col, score = best_of(
            _matrix(asks.column("asks")), visited[:, shelf.column("cell").to_numpy()], _matrix(shelf.column("vector")), low, k + 1
        )
        return pa.table({"query": asks.column("query").to_numpy()[row], "entry": shelf.column("entry").to_numpy()[col], "low": low[col], "score": score})

    at = ("shelf", "block", "part")
    work = shipped(compare)

    def run(key: tuple, asks: pa.Table, shelf: pa.Table) -> pa.Table:
        return work(key, asks, shelf)

    met = probes.groupBy(*at).cogroup(dealt.groupBy(*at)).applyInArrow(run, "query long, entry long, low long, score double")
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "low", "entry")
    best = met.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1).drop("place", "low")
    named = best.join(folded.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    found = asked.join(named, F.col("entry") == F.col("query")).where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))
