"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence has three limits at once: tokens, segments, and tokens that bear loss. The piece
put next into an open sequence is the one, among those that fit, whose demand has the
largest dot product with what is left, both in shares of the limits.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmark.llm.bpe import encoder, vocabulary
from tillmark.llm.common import Batches, map_batches, table


@dataclass(frozen=True)
class Limits:
    """Limits of a sequence. ``least`` is the shortest piece cut off to fill one up; 0: nothing is cut to fill."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    least: int = 16

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


@dataclass(frozen=True)
class Piece:
    """Tokens ``start`` to ``start + length`` of example ``owner``; ``loss`` of them bear loss."""

    owner: int
    start: int
    length: int
    loss: int


def cut(piece: Piece, length: int) -> tuple[Piece, Piece]:
    """Two pieces; the tokens that bear loss are taken to be the last ones, as in instruction data."""
    rest = piece.length - length
    late = min(piece.loss, rest)
    return (
        Piece(piece.owner, piece.start, length, piece.loss - late),
        Piece(piece.owner, piece.start + length, rest, late),
    )


class Packer:
    """Places pieces; those of equal demand are interchangeable and kept together as a class."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.share = 1 / np.array([limits.tokens, limits.segments, limits.loss], float)
        self.held: dict[tuple[int, int], list[Piece]] = defaultdict(list)
        self.tokens = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Keep a piece for later; what exceeds a limit alone leaves at once in full sequences."""
        most = self.limits
        while piece.length > most.tokens or piece.loss > most.loss:
            first = min(most.tokens, piece.length - piece.loss + most.loss)
            head, piece = cut(piece, first)
            yield [head]
        if piece.length:
            self.held[piece.length, piece.loss].append(piece)
            self.tokens += piece.length

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        keys = sorted(k for k, v in self.held.items() if v)
        demand = np.array([(a, 1, b) for a, b in keys], float).reshape(len(keys), 3)
        return demand, np.array([len(self.held[k]) for k in keys])

    def pack(self, keep_open: bool = False) -> Iterator[list[Piece]]:
        """Sequences of all that is held; with ``keep_open`` the last, if short, stays held."""
        demand, count = self._table()
        scaled = demand * self.share
        while count.any():
            left = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
            made: list[Piece] = []
            while left[0] > 0 and left[1] > 0:
                fits = (count > 0) & (demand <= left).all(axis=1)
                if fits.any():
                    value = scaled @ (left * self.share)
                    best = int(np.where(fits, value, -1.0).argmax())
                    piece = self._take(demand, count, best)
                elif self.limits.least and left[0] >= self.limits.least and (piece := self._part(demand, count, left)):
                    demand, count = self._table()
                    scaled = demand * self.share
                else:
                    break
                made.append(piece)
                left -= (piece.length, 1, piece.loss)
            if keep_open and left[0] > 0 and not count.any():
                for piece in made:
                    self.held[piece.length, piece.loss].append(piece)
                    self.tokens += piece.length
                return
            yield made

    def _take(self, demand: np.ndarray, count: np.ndarray, at: int) -> Piece:
        count[at] -= 1
        piece = self.held[int(demand[at, 0]), int(demand[at, 2])].pop()
        self.tokens -= piece.length
        return piece

    def _part(self, demand: np.ndarray, count: np.ndarray, left: np.ndarray) -> Piece | None:
        """The head of the longest piece, as long as the room left; its rest goes back."""
        for at in np.flatnonzero(count)[::-1].tolist():
            length = int(left[0])
            if demand[at, 0] <= length:
                return None
            head, rest = cut(self.held[int(demand[at, 0]), int(demand[at, 2])][-1], length)
            if head.loss <= left[2]:
                self._take(demand, count, at)
                self.held[rest.length, rest.loss].append(rest)
                self.tokens += rest.length
                return head
        return None


#: With a column of loss, ``loss_tokens long`` as well.
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _work(batches: Batches, path: str, limits: Limits, end: int, chunk: int) -> Iterator[dict]:
    coder, packer = encoder(path), Packer(limits)
    ids: dict[int, np.ndarray] = {}
    keys: dict[int, object] = {}
    sequence = TaskContext.get().partitionId() << 36
    number = 0

    def emit(sequences: Iterator[list[Piece]]) -> Iterator[dict]:
        nonlocal sequence
        out: dict[str, list] = defaultdict(list)
        for made in sequences:
            offset = 0
            for p in made:
                own = ids[p.owner]
                out["key"].append(keys[p.owner])
                out["start"].append(p.start)
                out["length"].append(p.length)
                out["ids_crc32"].append(zlib.crc32(own[p.start : p.start + p.length].astype("<u4").tobytes()))
                out["doc_tokens"].append(len(own))
                out["sequence_id"].append(sequence)
                out["offset"].append(offset)
                out["loss_tokens"].append(p.loss)
                offset += p.length
            sequence += 1
        if out:
            yield out

    def flush(last: bool) -> Iterator[dict]:
        yield from emit(packer.pack(keep_open=not last))
        alive = {p.owner for held in packer.held.values() for p in held}
        for owner in [o for o in ids if o not in alive]:
            del ids[owner], keys[owner]

    for batch in batches:
        key, text, loss = (batch.column(c).to_pylist() for c in ("key", "text", "loss"))
        for name, own, bearing in zip(key, coder.encode(text), loss, strict=True):
            ids[number], keys[number] = np.append(own, np.array([end], own.dtype)), name
            size = len(own) + 1
            yield from emit(packer.add(Piece(number, 0, size, size if bearing is None else min(max(bearing, 0), size))))
            number += 1
            if packer.tokens >= chunk or len(ids) >= chunk >> 4:
                yield from flush(False)
    yield from flush(True)


def pack(
    docs: DataFrame, path: str, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", end: int = 1, chunk: int = 1 << 21,
    loss: str | None = None,
) -> DataFrame:
    """Pieces of all texts in sequences within the limits; columns ``key`` and ``PIECES``.

    A text is its ids and ``end``. The column ``loss`` says how many tokens at its end bear loss, as in
    instruction data: all where it is NULL or no column is named, none below 0, all beyond the text's
    number. With it the pieces have ``loss_tokens`` too. NULL and empty texts are ``end``
    alone. A text longer than a sequence fills whole ones, the rest is packed, and a sequence
    that nothing fits any more is filled up with the head of a longer piece. Each task packs
    the rows it scans, about ``chunk`` tokens at a time, and hands a last short sequence on to
    the next chunk: no shuffle, bounded memory, one short sequence a task. Sequence ids hold
    the number of the task. Equal rows and NULL keys are packed row by row; an empty table
    gives no rows. Only ``key``, ``text`` and ``loss`` are read.
    """
    bearing = F.col(f"`{loss}`") if loss else F.lit(None)
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), bearing.cast("long").alias("loss"))
    columns = f"key {slim.schema['key'].dataType.simpleString()}, {PIECES}" + (", loss_tokens long" if loss else "")
    made = map_batches(slim, lambda batches: _work(batches, path, limits, end, chunk), columns)
    return made.withColumnRenamed("key", key)


def pack_examples(sizes: Sequence[tuple[int, int]], limits: Limits) -> list[list[Piece]]:
    """Sequences for examples given as (tokens, tokens that bear loss), for use inside a task."""
    packer, out = Packer(limits), []
    for i, (tokens, loss) in enumerate(sizes):
        out += packer.add(Piece(i, 0, tokens, loss))
    return out + list(packer.pack())


def op7_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary())
