"""Tables: idempotent replacement, bucket layout, inventories."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def create_or_replace(df: DataFrame, table: str) -> DataFrame:
    """Replace ``table`` by ``df`` and refresh its statistics.

    A plan that reads the table it replaces is refused by Spark; stage it first.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return spark.table(table)


def publish_version(df: DataFrame, name: str, keep: int = 2) -> DataFrame:
    """Write ``df`` as a new version of ``name`` and switch readers over to it once it is complete.

    ``name`` is a view of one version table. The switch is a single change of the catalog: readers
    see the old rows until then, also when the write fails half way, and ``df`` may read the table
    it replaces. The last ``keep`` versions stay, for queries that are still running; what a failed
    write has left behind goes with the next good one.
    """
    if keep < 1:
        raise ValueError("keep must be positive")
    spark = df.sparkSession
    prefix = f"{name}__v"
    numbers = _versions(spark, prefix)
    version = f"{prefix}{max(numbers, default=0) + 1:08d}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(version)
    spark.sql(f"ANALYZE TABLE {version} COMPUTE STATISTICS")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    good = sorted(spark.catalog.listTables(pattern=f"{prefix}*"), key=lambda t: t.name, reverse=True)
    for old in good[keep:]:
        spark.sql(f"DROP TABLE IF EXISTS {old.name}")
    return spark.table(name)


def _versions(spark: SparkSession, prefix: str) -> list[int]:
    return [int(t.name.removeprefix(prefix).split("_")[0]) for t in spark.catalog.listTables(pattern=f"{prefix}*")]


def write_buckets(buckets: DataFrame, table: str, files: int = 32) -> DataFrame:
    """LSH rows laid out for lookups: one folder per band, hashed and sorted by bucket key.

    A lookup reads one hash file of one folder and skips row groups by their value ranges.
    The rebalance hint brings rows of one file together before the write, and lets Spark
    split a file's rows over several tasks where a dense bucket makes them too many.
    """
    file = F.pmod(F.hash("bucket_hash"), F.lit(files))
    (
        buckets.withColumn("_file", file)
        .hint("rebalance", "band_id", "_file")
        .drop("_file")
        .write.mode("overwrite")
        .partitionBy("band_id")
        .bucketBy(files, "bucket_hash")
        .sortBy("bucket_hash")
        .saveAsTable(table)
    )
    return buckets.sparkSession.table(table)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of the given tables, by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts).orderBy("table_name")


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The same for all tables of a database."""
    listed = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    return inventory({t.name: spark.table(f"{t.namespace[0]}.{t.name}") for t in listed})
