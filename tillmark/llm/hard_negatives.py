"""Hard negatives by an inverted multi-index with certified windows.

Both halves of a vector are quantised apart; a cell is a pair of centroids. The inner product
with any vector of a cell is at most the sum of two half bounds, (q . c + |q| radius) a half.
A search visits cells from a heap in the order of that sum and stops when no cell left can hold
a row that would come before what it has found: the result is exact.

It runs in two rounds. The first visits the best cells until they hold enough entries. What it
found sets the mark that the bound of any further cell must reach; the second visits those.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillmark.llm.common import Batches, map_batches, shipped, table
from tillmark.llm.neighbours import fit, quantise
from tillmark.operators.skew import join_unique
from tillmark.staging import stage

#: Scaled components beyond this take no part: inner products of 2^9 components stay within 63 bits.
LARGEST = 1 << 27


@dataclass(frozen=True)
class Index:
    """Codebooks of the fourth root of the table's size, within ``fewest`` and ``most`` centroids a half.

    They are fitted on at most ``sample`` vectors in ``rounds`` rounds. The first round of a search
    visits cells of ``least`` entries. A task compares ``block`` entries with ``searches`` searches.
    """

    fewest: int = 4
    most: int = 64
    sample: int = 16384
    rounds: int = 10
    least: int = 2048
    block: int = 8192
    searches: int = 32768


def bounded_cells(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """Cells ``(bound, i, j)`` by descending ``first[i] + second[j]``, from a heap of one open cell a row."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
    while heap:
        low, i, j = heapq.heappop(heap)
        yield -low, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows with rows: by floating point while every sum is exact there."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def first_in_windows(
    asks: np.ndarray, labels: np.ndarray, windows: list[list[tuple[int, int]]], visited: np.ndarray,
    entries: np.ndarray, own: np.ndarray, low: np.ndarray, same: bool, k: int,
) -> tuple[np.ndarray, ...]:
    """``search, window, entry, score`` of the first ``k`` entries in each window of each search.

    Entries of the search's label (``same``) or of any other, in cells it visits; larger scores
    come first, ties by smaller ``low``.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(asks), 128):
        part = slice(at, at + 128)
        score = products(asks[part], entries)
        fits = visited[part] & ((labels[part, None] == own[None, :]) == same)
        most = max(map(len, windows[part]), default=0)
        for w in range(most):
            limits = np.array([x[w] if w < len(x) else (1, 0) for x in windows[part]], np.int64)
            open_ = fits & (score >= limits[:, :1]) & (score <= limits[:, 1:])
            row, col = np.nonzero(open_)
            if not len(row):
                continue
            if len(row) > k * len(open_):
                held = np.where(open_, score, np.iinfo(np.int64).min)
                edge = np.partition(held, -k, axis=1)[:, -k] if held.shape[1] > k else held.min(axis=1)
                row, col = np.nonzero(open_ & (score >= edge[:, None]))
            value = score[row, col]
            order = np.lexsort((low[col], -value, row))
            row, col, value = row[order], col[order], value[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((row[first] + at, np.full(first.sum(), w), col[first], value[first]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class Cells:
    """The index as tasks see it: codebooks, radii, entries a cell and blocks a shelf."""

    def __init__(self, books: list[np.ndarray], radii: list[np.ndarray], held: np.ndarray, blocks: np.ndarray):
        self.books, self.radii, self.held, self.blocks = books, radii, held, blocks
        self.half = books[0].shape[1]

    def bounds(self, ask: np.ndarray, side: int, sign: int) -> np.ndarray:
        """The largest (``sign`` 1) or smallest (-1) product the members of a half cell can have, with room for rounding."""
        part = ask[: self.half] if side == 0 else ask[self.half :]
        length = np.sqrt((part * part).sum())
        book, radius = self.books[side], self.radii[side]
        room = length * (radius + 1e-9 * (radius + np.sqrt((book * book).sum(axis=1)))) + 0.5
        return book @ part + sign * room

    def walk(self, ask: np.ndarray, ceiling: float) -> Iterator[tuple[float, int, int]]:
        """Cells that hold entries, by descending bound; not those whose members all lie above ``ceiling``."""
        least = self.bounds(ask, 0, -1), self.bounds(ask, 1, -1)
        for bound, i, j in bounded_cells(self.bounds(ask, 0, 1), self.bounds(ask, 1, 1)):
            if self.held[i, j] and least[0][i] + least[1][j] <= ceiling:
                yield bound, i, j

    def best(self, ask: np.ndarray, least: int, floor: float, ceiling: float) -> list[tuple[int, int]]:
        """The first cells until they hold ``least`` entries or bounds fall below ``floor``."""
        seen, out = 0, []
        for bound, i, j in self.walk(ask, ceiling):
            if seen >= least or bound < floor:
                break
            out.append((i, j))
            seen += int(self.held[i, j])
        return out

    def further(self, ask: np.ndarray, least: int, floor: float, ceiling: float, mark: float) -> list[tuple[int, int]]:
        """All cells but those of ``best`` whose bound reaches ``mark``: what lies beyond is certified not to matter."""
        done = set(self.best(ask, least, floor, ceiling))
        out = []
        for bound, i, j in self.walk(ask, ceiling):
            if bound < mark:
                break
            if (i, j) not in done:
                out.append((i, j))
        return out


def participants(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id, label, vector`` of the rows that take part; components are ``floor(scale * x)``."""
    raw = df.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("raw")
    )
    sound = F.forall("raw", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(LARGEST / scale)))
    taken = raw.where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound & (F.size("raw") > 0))
    return taken.select("id", "label", F.transform("raw", lambda c: F.floor(F.lit(float(scale)) * c).cast("double")).alias("vector"))


def build(folded: DataFrame, index: Index) -> tuple[DataFrame, Cells]:
    """Entries with their cell, and the index; codebooks, radii and counts are bounded by the codebooks' size (an action)."""
    count = folded.count()
    centroids = int(np.clip(round(count**0.25), index.fewest, index.most))
    drawn = folded.orderBy(F.xxhash64("vector"), "entry").limit(index.sample).select("vector").toArrow()
    sample = matrix(drawn.column("vector"))
    half = max(1, sample.shape[1] // 2)
    books = [fit(part, centroids, index.rounds) if part.shape[1] else np.zeros((1, 0)) for part in (sample[:, :half], sample[:, half:])]

    def place(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                own = matrix(batch.column("vector"))
                out = {c: batch.column(c) for c in ("entry", "vector", "label", "low")}
                for name, far, book, part in (("shelf", "far_1", books[0], own[:, :half]), ("cell", "far_2", books[1], own[:, half:])):
                    at = quantise(part, book)
                    out |= {name: at, far: np.sqrt(((part - book[at]) ** 2).sum(axis=1))}
                yield out

    low = folded.select("entry", "vector", "label", F.element_at("ids", 1).alias("low"))
    entries = stage(map_batches(low, place, "entry long, vector array<double>, label long, low long, shelf int, cell int, far_1 double, far_2 double"), "entries")
    held = np.zeros((len(books[0]), len(books[1])), np.int64)
    radii = [np.zeros(len(book)) for book in books]
    for row in entries.groupBy("shelf", "cell").agg(F.count("*").alias("n"), F.max("far_1").alias("a"), F.max("far_2").alias("b")).collect():
        held[row["shelf"], row["cell"]] = row["n"]
        radii[0][row["shelf"]] = max(radii[0][row["shelf"]], row["a"])
        radii[1][row["cell"]] = max(radii[1][row["cell"]], row["b"])
    return entries.drop("far_1", "far_2"), Cells(books, radii, held, np.maximum(1, -(-held.sum(axis=1) // index.block)))


def meet(searches: DataFrame, entries: DataFrame, cells: Cells, index: Index, same: bool, k: int, marked: bool) -> DataFrame:
    """``search, window, entry, score, low`` found in the cells of one round."""
    groups = max(1, -(-searches.count() // index.searches))

    def route(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("shelf", "block", "search", "asks", "label", "lows", "highs", "cells")}
            own = matrix(batch.column("vector")) if batch.num_rows else ()
            told = [batch.column(c).to_pylist() for c in ("search", "label", "lows", "highs", "mark")]
            for ask, search, label, lows, highs, mark in zip(own, *told, strict=True):
                limits = (index.least, min(lows), max(highs))
                visits: dict[int, list[int]] = {}
                for i, j in cells.further(ask, *limits, mark) if marked else cells.best(ask, *limits):
                    visits.setdefault(i, []).append(j)
                for shelf, at in visits.items():
                    for block in range(cells.blocks[shelf]):
                        for c, v in zip(out, (shelf, block, search, ask, label, lows, highs, at), strict=True):
                            out[c].append(v)
            yield out

    probes = map_batches(
        searches.select("search", "vector", "label", "lows", "highs", "mark"), route,
        "shelf int, block int, search long, asks array<double>, label long, lows array<long>, highs array<long>, cells array<int>",
    ).withColumn("part", F.pmod(F.xxhash64("search"), F.lit(groups)).cast("int"))
    per_shelf = F.element_at(F.array(*[F.lit(int(b)) for b in cells.blocks]), F.col("shelf") + 1)
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("entry"), per_shelf).cast("int"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = len(cells.books[1])

    def compare(asks: pa.Table, shelf: pa.Table) -> pa.Table:
        kinds = {"search": "int64", "window": "int32", "entry": "int64", "score": "int64", "low": "int64"}
        if not asks.num_rows or not shelf.num_rows:
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        at = asks.column("cells").combine_chunks()
        visited = np.zeros((asks.num_rows, names), bool)
        visited[np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy())), at.flatten().to_numpy()] = True
        windows = [list(zip(a, b, strict=True)) for a, b in zip(asks.column("lows").to_pylist(), asks.column("highs").to_pylist(), strict=True)]
        cell, low = shelf.column("cell").to_numpy(), shelf.column("low").to_numpy()
        vectors, own, label = matrix(shelf.column("vector")).astype(np.int64), shelf.column("label").to_numpy(), asks.column("label").to_numpy()
        ask = matrix(asks.column("asks")).astype(np.int64)
        parts = []
        for start in range(0, len(ask), 1024):  # bounds the table of searches and entries
            p = slice(start, start + 1024)
            row, window, col, score = first_in_windows(ask[p], label[p], windows[p], visited[p][:, cell], vectors, own, low, same, k)
            parts.append((row + start, window, col, score))
        row, window, col, score = (np.concatenate(c) for c in zip(*parts, strict=True))
        made = (asks.column("search").to_numpy()[row], window, shelf.column("entry").to_numpy()[col], score, low[col])
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(kinds.items(), made, strict=True)})

    work, at = shipped(compare), ("shelf", "block", "part")

    def run(asks: pa.Table, shelf: pa.Table) -> pa.Table:
        return work(asks, shelf)

    met = probes.groupBy(*at).cogroup(dealt.groupBy(*at)).applyInArrow(run, "search long, window int, entry long, score long, low long")
    return stage(_first(met, k), "met")


def _first(met: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("search", "window").orderBy(F.desc("score"), "low", "entry")
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def first_rows(searches: DataFrame, folded: DataFrame, entries: DataFrame, cells: Cells, index: Index, same: bool, k: int) -> DataFrame:
    """``search, window, rows``: the first ``k`` rows of each window as sorted ``(down, id)``, ``down`` the negative score (an action).

    ``searches``: ``search, vector, label, lows, highs`` with the windows' limits.
    """
    unmarked = searches.withColumn("mark", F.lit(0).cast("long"))
    begun = meet(unmarked, entries, cells, index, same, k, marked=False)
    # A full window needs no row below its last score, any other none below its limit.
    reached = begun.groupBy("search", "window").agg(F.count("*").alias("n"), F.min("score").alias("last")).where(F.col("n") >= k)
    marks = reached.groupBy("search").agg(F.map_from_entries(F.collect_list(F.struct("window", "last"))).alias("last"))
    mark = F.array_min(F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("last", w), low))))
    marked = stage(searches.join(marks, "search", "left").withColumn("mark", mark).drop("last"), "marked")
    met = stage(_first(begun.union(meet(marked, entries, cells, index, same, k, marked=True)), k), "met")
    named = join_unique(met, folded.select("entry", "ids"), ["entry"])
    rows = named.select("search", "window", (-F.col("score")).alias("down"), F.explode("ids").alias("id"))
    order = Window.partitionBy("search", "window").orderBy("down", "id")
    kept = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return kept.groupBy("search", "window").agg(F.sort_array(F.collect_list(F.struct("down", "id"))).alias("rows"))


def mine(
    df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    index: Index = Index(), key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """Hard negatives ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` (an action).

    Anchors are the rows whose id ``every`` divides. Their positives are the first ``positives``
    rows of the same label and another id; for each, the first ``negatives`` rows of another label
    whose score is ``low`` to ``high`` per cent of the positive's. Scores are integer inner
    products of ``floor(scale * x)``; larger ones come first, ties by the smaller id.

    The result is exact, whatever the index. Rows take no part if id, label or vector is NULL, the
    vector is empty, holds NULL or non-finite components or one beyond ``LARGEST / scale``, or its
    length is not the most common one (of equally common ones the smaller). Equal rows count once;
    rows of equal vector and label are one entry with the smallest ids that any result can need,
    and one search. An empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = participants(df, key, vector, label, scale)
    length = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if length is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == length["size"])
    keep = max(positives + 1, negatives)
    place = F.row_number().over(Window.partitionBy("vector", "label").orderBy("id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= keep)
    folded = few.groupBy("vector", "label").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    folded = stage(folded.withColumn("entry", F.monotonically_increasing_id()), "vectors")
    anchors = stage(rows.where(F.col("id") % every == 0).distinct(), "anchors")
    of = folded.select("vector", "label", F.col("entry").alias("search"))
    anchors = stage(join_unique(anchors, of, ["vector", "label"]).select(F.col("id").alias("anchor_id"), "search"), "anchors")
    entries, cells = build(folded, index)

    asked = folded.join(anchors.select(F.col("search").alias("entry")).distinct(), "entry", "left_semi")
    limit = F.lit(1 << 62)
    searches = asked.select(F.col("entry").alias("search"), "vector", "label", F.array(-limit).alias("lows"), F.array(limit).alias("highs"))
    same = first_rows(stage(searches, "searches"), folded, entries, cells, index, True, positives + 1).drop("window")
    scores = F.array_sort(F.array_distinct(F.filter(F.transform("rows", lambda r: -r["down"]), lambda s: s >= 0)))
    told = searches.select("search", "vector", "label").join(same, "search").withColumn("scores", scores)
    # In hundreds and a rest nothing overflows; limits are whole numbers, so rounding inwards is exact.
    told = told.withColumn("lows", F.expr(f"transform(scores, s -> {low} * (s div 100) + ({low} * (s % 100) + 99) div 100)"))
    told = told.withColumn("highs", F.expr(f"transform(scores, s -> {high} * (s div 100) + ({high} * (s % 100)) div 100)"))
    told = stage(told, "windows")
    wanted = told.where(F.size("scores") > 0).select("search", "vector", "label", "lows", "highs")
    other = first_rows(wanted, folded, entries, cells, index, False, negatives)

    mine_ = join_unique(anchors, told.select("search", "rows", "scores"), ["search"])
    own = F.slice(F.filter("rows", lambda r: r["id"] != F.col("anchor_id")), 1, positives)
    pairs = mine_.withColumn("p", F.explode(own)).select(
        "anchor_id", "search", F.col("p.id").alias("positive_id"), (-F.col("p.down")).alias("positive_score"),
        (F.array_position("scores", -F.col("p.down")) - 1).cast("int").alias("window"),
    )
    found = join_unique(stage(pairs, "pairs"), stage(other, "negatives"), ["search", "window"])
    listed = found.select("anchor_id", "positive_id", "positive_score", F.posexplode("rows").alias("rank", "r"))
    return listed.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("r.id").alias("negative_id"), "positive_score", (-F.col("r.down")).alias("negative_score")
    )


def op12_inverted_multi_index_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved))


ORACLE = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
