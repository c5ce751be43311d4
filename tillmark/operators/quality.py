"""Key and reference checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tillmark.staging import stage


def repeated_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and the rows they hold."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return counts.agg(
        F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    ).select(*_label("primary key", table, ",".join(keys)), "keys", "rows")


def orphans(df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values without a parent row.  Values are counted first, so a hot one is one row."""
    values = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias("_parent"))
    lost = values.join(parents, F.col(key) == F.col("_parent"), "left_anti")
    return lost.agg(
        F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    ).select(*_label("reference", table, key), "keys", "rows")


class KeyCounts:
    """Rows per value of several column groups of one table, counted in one scan and stored (an action)."""

    def __init__(self, df: DataFrame, table: str, *groups: Sequence[str]):
        self.table = table
        self.columns = sorted({c for g in groups for c in g})
        sets = [[F.col(c) for c in g] for g in groups]
        counted = df.groupingSets(sets, *self.columns).agg(
            F.count("*").alias("n"), F.grouping_id(*self.columns).alias("_set")
        )
        self.counts = stage(counted, f"keys-{table}")

    def of(self, group: Sequence[str]) -> DataFrame:
        """``group`` columns and ``n``; columns outside the group set a bit of the id, the first the highest."""
        own = sum(1 << i for i, c in enumerate(reversed(self.columns)) if c not in group)
        return self.counts.where(F.col("_set") == own).select(*group, "n")

    def repeated(self, group: Sequence[str]) -> DataFrame:
        found = self.of(group).where("n > 1")
        return _summed(found).select(*_label("primary key", self.table, ",".join(group)), "keys", "rows")

    def orphans(self, key: str, parent: KeyCounts, parent_key: str) -> DataFrame:
        parents = parent.of([parent_key]).select(F.col(parent_key).alias("_parent"))
        values = self.of([key]).where(F.col(key).isNotNull())
        lost = values.join(parents, F.col(key) == F.col("_parent"), "left_anti")
        return _summed(lost).select(*_label("reference", self.table, key), "keys", "rows")


def _summed(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def missing_values(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts of all ``columns`` in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("rows")) for c in columns])
    return counted.select(F.explode(entries).alias("e")).select(
        *_label("not null", table, F.col("e.columns")), F.lit(0).cast("bigint").alias("keys"), "e.rows"
    )


def violations(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def _label(check, table, columns):
    columns = F.lit(columns) if isinstance(columns, str) else columns
    return F.lit(check).alias("check"), F.lit(table).alias("table_name"), columns.alias("columns")
