"""Joins whose hot keys need no help from the planner."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_unique(rows: DataFrame, found: DataFrame, keys: list[str], share: int = 256) -> DataFrame:
    """``rows`` with the columns of ``found`` (one row a key), NULL where it has none; NULL keys match NULL keys.

    A key that holds more than one ``share``-th of all rows would be one task's work. Fewer than
    ``share`` such keys can exist, so theirs is a broadcast of proven size (the counts are an action);
    all other keys meet in an ordinary join. ``rows`` is read several times: pass a written
    table. No other column of ``found`` may be named like one of ``rows``.
    """
    total = rows.count()
    heavy = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") * share > total).drop("_n")
    hot = [tuple(r) for r in heavy.collect()]  # fewer than ``share`` rows
    new = [c for c in found.columns if c not in keys]
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    on = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]

    def met(some: DataFrame, other: DataFrame) -> DataFrame:
        return some.join(other.withColumnsRenamed(names), on, "left").select(*rows.columns, *new)

    if not hot:
        return met(rows, found)
    listed = F.broadcast(rows.sparkSession.createDataFrame(hot, rows.select(*keys).schema).withColumnsRenamed(names))
    few = F.broadcast(found.join(listed, on, "left_semi"))
    return met(rows.join(listed, on, "left_semi"), few).union(met(rows.join(listed, on, "left_anti"), found))
