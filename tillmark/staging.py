"""Intermediate tables in the shared folder of the cluster.

A staged table cuts the lineage like a reliable checkpoint, survives the loss of
executors, and - unlike a checkpointed RDD - keeps columnar pruning and file
statistics for the stages that read it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; an error on a cluster that names none.

    A session on this machine alone, as in tests, uses a folder in its warehouse then.
    """
    root = spark.conf.get(_KEY, None)
    if not root:
        if spark.conf.get("spark.master", "").partition("[")[0] != "local":
            raise ValueError(f"set {_KEY} to a folder that all executors can reach")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set(_KEY, root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    app = spark.sparkContext.applicationId
    return f"{staging_root(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet under the staging folder and read it back (an action)."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
