"""Comparison of texts in blocks: a text, or its packed set, moves once a block, never once a pair.

Work inside a block is numpy on sets of packed trigrams. The functions travel to the executors
by value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillmark.functions.hashing import set_reader, set_unpacker

ID = "notice_id"
PAIR = ("notice_id_a", "notice_id_b")


def _overlap():
    """Function that counts the shared elements of two ascending arrays of distinct numbers."""

    def overlap(x, y):
        if len(x) == len(y) and np.array_equal(x, y):
            return len(x)
        both = np.concatenate((x, y))
        both.sort(kind="stable")  # two ascending runs: a merge
        return int(np.count_nonzero(both[1:] == both[:-1]))

    return overlap


def score_in_blocks(pairs: DataFrame, texts: DataFrame, columns: Sequence[str], signature: str | None = None, block: int = 1024) -> DataFrame:
    """``pairs`` with the exact similarity of two texts, one row for each of ``columns``.

    ``texts`` has one row a ``notice_id`` with lower-cased texts in ``columns``. The new columns are
    ``strategy`` (the text column's name), ``jaccard``, and with ``signature`` (a column of
    ``texts``) ``estimate``, the share of equal slots. Ids are dealt into blocks of about ``block``;
    a pair belongs to a square of two blocks, so an id with very many pairs is spread over all squares
    of its row. Squares, which outnumber the pairs where these are few, are dealt into as many groups
    as hold about ``block`` pairs each, and a text goes once to each group that needs it: the groups grow with the
    pairs, not with the square of the texts. NULL texts are empty, two empty sets have similarity 0.0,
    pairs with an unknown id are left out. ``pairs`` is read several times: pass a written table.
    """
    count = -(-texts.count() // block) or 1
    groups = -(-pairs.count() // block) or 1

    def own(column):
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    keyed = pairs.withColumn("_row", F.pmod(F.xxhash64(own(PAIR[0]), own(PAIR[1])), F.lit(groups)).cast("int"))
    sides = [keyed.select(F.col("_row").alias("_to_row"), F.col(side).alias(ID)) for side in PAIR]
    extra = [signature] if signature else []
    sent = sides[0].union(sides[1]).distinct().join(texts.select(ID, *columns, *extra), ID)
    made = "strategy string, jaccard double" + (", estimate double" if signature else "")
    schema = StructType([*pairs.schema.fields, *StructType.fromDDL(made).fields])
    arrow, names = to_arrow_schema(schema), list(columns)
    read, overlap = set_reader(), _overlap()

    def work(asked: pa.Table, told: pa.Table) -> pa.Table:
        place = {i: n for n, i in enumerate(told.column(ID).to_pylist())}
        at = [[place.get(i, -1) for i in asked.column(side).to_pylist()] for side in PAIR]
        rows = [n for n, (x, y) in enumerate(zip(*at)) if x >= 0 and y >= 0]
        x, y = ([side[n] for n in rows] for side in at)
        kept = asked.select([f.name for f in arrow if f.name in asked.column_names]).take(pa.array(rows, pa.int64()))
        shares = None
        if signature and rows:
            slots = told.column(signature).combine_chunks()
            slots = slots.flatten().to_numpy().reshape(len(slots), -1)
            shares = pa.array((slots[x] == slots[y]).sum(axis=1) / slots.shape[1])
        parts = []
        for name in names if rows else ():
            lengths, found = read(told.column(name).combine_chunks())
            ends = np.cumsum(lengths)
            sets = [found[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist())]
            scores = []
            for i, j in zip(x, y):
                shared = overlap(sets[i], sets[j])
                scores.append(shared / (len(sets[i]) + len(sets[j]) - shared) if len(sets[i]) + len(sets[j]) else 0.0)
            part = kept.append_column("strategy", pa.array([name] * len(rows))).append_column("jaccard", pa.array(scores, pa.float64()))
            parts.append(part.append_column("estimate", shares) if shares is not None else part)
        return pa.concat_tables(parts).cast(arrow) if parts else arrow.empty_table()

    def run(asked: pa.Table, told: pa.Table) -> pa.Table:
        return work(asked, told)

    return keyed.groupBy("_row").cogroup(sent.groupBy("_to_row")).applyInArrow(run, schema)


def _shared_counter():
    """Function that prepares sets of packed trigrams for counting what members of one share with members of another part.

    It returns a function of rows and columns of the matrix of intersection sizes. Trigrams that many
    members hold are a 0/1 matrix and its product; of the others, which are most, the lists of their
    holders are counted up; a member with itself is not counted right. What is made stays a small multiple of the sets themselves.
    """
    at_once = 1 << 20

    def prepare(lengths, found):
        n = len(lengths)
        codes, column, often = np.unique(found, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(n), lengths)
        first = np.concatenate(([0], np.cumsum(lengths)))
        common = often >= max(2, n // 10)
        rare = (often > 1) & ~common
        place = np.cumsum(common) - 1
        matrix = np.zeros((n, int(common.sum())), np.float32)
        held = common[column]
        matrix[row[held], place[column[held]]] = 1
        holders = row[np.argsort(column, kind="stable")] if rare.any() else None
        start = np.cumsum(often) - often

        def shared(low, high, left, right):
            total = (matrix[low:high] @ matrix[left:right].T).astype(np.float64)
            if holders is None:
                return total
            mine, own = column[first[low] : first[high]], row[first[low] : first[high]] - low
            few = rare[mine]
            mine, own = mine[few], own[few]
            ends = np.cumsum(often[mine])
            at = 0
            while at < len(mine):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + at_once, side="right")))
                count = often[mine[at:to]]
                where = np.arange(count.sum()) + np.repeat(start[mine[at:to]] - np.cumsum(count) + count, count)
                i, j = np.repeat(own[at:to], count), holders[where]
                inside = (j >= left) & (j < right)
                total += np.bincount(i[inside] * (right - left) + j[inside] - left, minlength=total.size).reshape(total.shape)
                at = to
            return total

        return shared

    return prepare


def near_in_squares(squares: DataFrame, threshold: float, listed: bool = False) -> DataFrame:
    """What each square of a bucket finds: edges that connect its near members, and each member's links.

    ``squares``: ``square, diagonal, notice_id, own, weight, prior, packed`` (see ``gram_packed``). Two members are compared if
    the square is diagonal or they come from different blocks (``own``), and count if no entry of
    ``prior`` is equal in both: then this is the first bucket that holds the two. Rows with
    ``notice_id_b`` are edges, with ``jaccard``, between members that no earlier bucket and no earlier
    edge of this square connects; the others give the ``links`` of a member, the weights of those near
    to it added up. A square makes at most two rows a member. With ``listed`` the rows are all near
    pairs that count, smaller id first, and nothing else. A square is worked on some rows at a time.
    """
    kind = squares.schema[ID].dataType
    schema = StructType.fromDDL("jaccard double, links long").add(PAIR[0], kind).add(PAIR[1], kind)
    arrow = to_arrow_schema(schema)
    unpack, prepare = set_unpacker(), _shared_counter()
    cells, rows_at_once, flush = 1 << 20, 512, 1 << 16

    def tiles(lengths, found, split):
        """Index arrays and scores of the near pairs, some rows of the square at a time."""
        n = len(lengths)
        shared = prepare(lengths, found)
        low, end = 0, split or n
        while low < end:
            left = split or low
            high = min(end, low + max(1, min(rows_at_once, cells // (n - left))))
            both = shared(low, high, left, n)
            union = lengths[low:high, None] + lengths[None, left:] - both
            score = np.divide(both, union, out=np.zeros_like(both), where=union > 0)
            near = score >= threshold
            i, j = np.nonzero(near if split else np.triu(near, 1))
            yield i + low, j + left, score[i, j]
            low = high

    def connect(part, i, j):
        """Positions of pairs that join two parts not joined before; ``part`` is brought up to date."""
        chosen = []
        open_ = np.flatnonzero(part[i] != part[j])
        for at in np.split(open_, np.flatnonzero(np.diff(i[open_])) + 1) if len(open_) else ():
            x = i[at[0]]
            other = part[j[at]]
            names, first = np.unique(other, return_index=True)
            new = names != part[x]
            if new.any():
                chosen.extend(at[first[new]].tolist())
                part[np.isin(part, names)] = part[x]
        return chosen

    def settle(members, diagonal):
        members.sort(key=lambda m: m[1])
        ids, own, weight, prior, packed = zip(*members)
        split = 0 if diagonal else sum(o == own[0] for o in own)
        if split == len(ids):
            return
        sets = [unpack(raw) for raw in packed]
        lengths, found = np.array([len(s) for s in sets], np.int64), np.concatenate(sets)
        del sets
        keys = [np.unique(np.array(band, "S16"), return_inverse=True)[1] for band in zip(*prior)]
        weight, part = np.array(weight, np.int64), np.arange(len(ids))
        links = np.zeros(len(ids), np.int64)
        for i, j, score in tiles(lengths, found, split):
            met = np.zeros(len(i), bool)
            for key in keys:
                met |= key[i] == key[j]
            if not listed:
                connect(part, i[met], j[met])
            i, j, score = i[~met], j[~met], score[~met]
            chosen = range(len(i)) if listed else connect(part, i, j)
            for n in chosen:
                x, y = ids[i[n]], ids[j[n]]
                yield (x, y, float(score[n]), None) if not listed or x < y else (y, x, float(score[n]), None)
            links += np.bincount(i, weight[j], len(ids)).astype(np.int64) + np.bincount(j, weight[i], len(ids)).astype(np.int64)
        if not listed:
            yield from ((i, None, None, n) for i, n in zip(ids, links.tolist()) if n)

    def run(batches):
        def table(out):
            made = {PAIR[0]: 0, PAIR[1]: 1, "jaccard": 2, "links": 3}
            return pa.RecordBatch.from_arrays([pa.array([r[made[f.name]] for r in out], f.type) for f in arrow], schema=arrow)

        def settled():
            square, diagonal, members = None, True, []
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("square", "diagonal", ID, "own", "weight", "prior", "packed")]
                for key, whole, *member in zip(*columns):
                    if key != square:
                        if len(members) > 1:
                            yield from settle(members, diagonal)
                        square, diagonal, members = key, whole, []
                    members.append(member)
            if len(members) > 1:
                yield from settle(members, diagonal)

        out = []
        for found in settled():
            out.append(found)
            if len(out) >= flush:
                yield table(out)
                out = []
        if out:
            yield table(out)

    columns = ("square", "diagonal", ID, "own", "weight", "prior", "packed")
    return squares.select(*columns).repartition("square").sortWithinPartitions("square").mapInArrow(run, schema)
