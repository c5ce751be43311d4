"""Keep-latest de-duplication and the load checksum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: str) -> DataFrame:
    """One row per key: the one with the greatest ``latest``, NULL last.

    All other columns break ties, so the result does not depend on row order.  The
    ``= 1`` filter is planned as a group limit that runs before the shuffle as well:
    each task sends on at most one row per key, however often a key repeats.
    """
    ties = [F.col(c).desc_nulls_last() for c in df.columns if c != latest and c not in keys]
    window = Window.partitionBy(*keys).orderBy(F.col(latest).desc_nulls_last(), *ties)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def load_checksum(fact: DataFrame) -> DataFrame:
    """Row count and total quantity; equal over repeated loads."""
    return fact.agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("quantity").cast("decimal(24,6)")).cast("double").alias("check_sum"),
    )
