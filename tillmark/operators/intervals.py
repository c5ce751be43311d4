"""Joins of dated rows to validity intervals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmark.staging import stage


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    bounds: str = "[]",
    how: str = "left",
    slice_days: int | None = None,
    horizon: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Rows of ``points`` with the intervals of their key that contain ``at``.

    A NULL ``end`` is open.  ``bounds`` is ``"[]"`` (last day included) or ``"[)"``.
    Spark decides by size whether ``intervals`` is broadcast; otherwise both sides
    are shuffled by key and adaptive execution splits a hot key of ``points``.

    With ``slice_days`` and ``horizon`` the calendar is cut into slices that join the
    key: the rows of a hot key spread over the slices, and a point meets only
    intervals that touch its slice.  Days outside the horizon count to its first or
    last slice, so the horizon affects speed only, never the result.  This form is
    always shuffled: the size of ``intervals`` is unknown once cut into slices.
    """
    if bounds not in ("[]", "[)"):
        raise ValueError("bounds must be '[]' or '[)'")
    keep = [c for c in intervals.columns if c not in keys]
    right = intervals.select(*[F.col(k).alias(f"_{k}") for k in keys], *keep)
    left = points
    match = F.lit(True)
    if slice_days is not None:
        if horizon is None:
            raise ValueError("slices need a horizon")
        first = _slice(F.col(start), slice_days, horizon)
        last = _slice(F.coalesce(F.col(end), F.lit(horizon[1])), slice_days, horizon)
        left = left.withColumn("_slice", _slice(F.col(at), slice_days, horizon))
        right = right.where(first <= last).withColumn("_slot", F.explode(F.sequence(first, last)))
        right = right.hint("merge")
        match = F.col("_slice") == F.col("_slot")
    for k in keys:
        match = match & (F.col(k) == F.col(f"_{k}"))
    below = F.col(at) <= F.col(end) if bounds == "[]" else F.col(at) < F.col(end)
    match = match & (F.col(at) >= F.col(start)) & (below | F.col(end).isNull())
    joined = left.join(right, match, how)
    return joined.drop("_slice", "_slot", *[f"_{k}" for k in keys])


def _slice(day: Column, slice_days: int, horizon: tuple[dt.date, dt.date]) -> Column:
    first, last = (F.lit(d) for d in horizon)
    clamped = F.when(day < first, first).when(day > last, last).otherwise(day)
    return F.floor(F.datediff(clamped, first) / slice_days).cast("int")


def sweep_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    bounds: str = "[]",
    how: str = "left",
    parts: int | None = None,
    hot_rows: int = 100_000,
) -> DataFrame:
    """The rows of :func:`interval_join`, by one pass over points and interval starts in order (an action).

    Starts and points of a key form one stream in time; the last start is carried forward and
    its end decides, so no point meets more than one interval. The stream is shuffled and sorted
    once, by key. A key that is hot on both sides must not go to one task: rows are counted by
    hashes of the key first, and keys whose hash has more than ``hot_rows`` rows and far more than
    the others are dealt into ``parts`` ranges of (key, time); what a range needs from earlier ones
    is its key's last start before it. Keys whose intervals overlap are found on the way and handed
    to :func:`interval_join`. Points with a NULL key or time, and intervals that contain nothing,
    never enter the stream. Both sides are read more than once: store what is dear to make.
    """
    if bounds not in ("[]", "[)"):
        raise ValueError("bounds must be '[]' or '[)'")
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    spark = points.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in intervals.columns if c not in keys]
    names = [f"_k{n}" for n in range(len(keys))]
    known = [F.col(k).isNotNull() for k in keys]
    holds = F.col(end).isNull() | (F.col(start) <= F.col(end) if bounds == "[]" else F.col(start) < F.col(end))
    whole = F.lit(True)
    for k in known:
        whole = whole & k
    sound = intervals.where(whole & F.col(start).isNotNull() & holds)
    asked = points.where(whole & F.col(at).isNotNull())
    own = [F.col(k).alias(n) for k, n in zip(keys, names)]
    interval, point = F.struct(*rest), F.struct(*points.columns)
    starts = sound.select(*own, F.col(start).alias("_t"), F.lit(0).alias("_kind"), interval.alias("_i"))
    dated = asked.select(*own, F.col(at).alias("_t"), F.lit(1).alias("_kind"), point.alias("_p"))
    stream = starts.unionByName(dated, allowMissingColumns=True)
    slot = F.pmod(F.xxhash64(*names), F.lit(16 * parts))
    sizes = stream.groupBy(slot.alias("_slot")).count().collect()
    most = max(hot_rows, sum(r["count"] for r in sizes) / (4 * parts))
    hot = [r["_slot"] for r in sizes if r["count"] > most]

    order = Window.partitionBy(*names).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    cold = stream.where(~slot.isin(hot)) if hot else stream
    ordered = cold.withColumn("_last", F.last("_i", ignorenulls=True).over(order))
    if hot:
        ordered = ordered.unionByName(_swept_ranges(stream.where(slot.isin(hot)), names, parts))
    until = F.col(f"_last.`{end}`")
    open_ = F.col("_last").isNotNull() & (until.isNull() | (F.col("_t") <= until if bounds == "[]" else F.col("_t") < until))
    start_ = F.col("_kind") == 0
    swept = ordered.where(~start_ | open_).select(  # of the starts only those within another interval are kept
        "_kind", *[F.when(start_, F.col(n)).alias(n) for n in names], "_p", F.when(open_, F.col("_last")).alias("_last")
    )
    swept = stage(swept, "swept")
    tangled = stage(swept.where("_kind = 0").select(*names).distinct(), "tangled")
    none = tangled.isEmpty()
    met = swept.where("_kind = 1").select("_p.*", *[F.col(f"_last.`{c}`").alias(c) for c in rest], F.col("_last").isNotNull().alias("_hit"))
    again = tangled.withColumnsRenamed(dict(zip(names, keys)))
    found = met if none else met.join(again, list(keys), "left_anti").select(*met.columns)
    found = (found if how == "left" else found.where("_hit")).drop("_hit")
    if not none:
        other = interval_join(
            asked.join(again, list(keys), "left_semi").select(*points.columns), sound.join(again, list(keys), "left_semi"), keys, at, start, end, bounds, how
        )
        found = found.unionByName(other)
    if how == "inner":
        return found
    alone = points.where(~F.coalesce(whole & F.col(at).isNotNull(), F.lit(False)))
    return found.unionByName(alone, allowMissingColumns=True)


def _swept_ranges(stream: DataFrame, names: Sequence[str], parts: int) -> DataFrame:
    """``stream`` with the last start before each row of its key as ``_last``, by ranges of (key, time) (an action)."""
    columns = stream.columns
    ranges = stream.withColumn("_tie", F.xxhash64("_p")).repartitionByRange(parts, *names, "_t", "_kind", "_tie")
    ranges = stage(ranges.withColumn("_range", F.spark_partition_id()), "stream")
    last = ranges.groupBy(*names, "_range").agg(F.max_by("_i", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_i"))
    before = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*names, "_range", F.last("_i", ignorenulls=True).over(before).alias("_carried"))
    order = Window.partitionBy(*names, "_range").orderBy("_t", "_kind")
    earlier = F.last("_i", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = ranges.withColumn("_earlier", earlier).join(carried, [*names, "_range"])
    return joined.select(*columns, F.coalesce("_earlier", "_carried").alias("_last"))
