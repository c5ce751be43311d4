"""Object store and database sources.  Credentials come from the environment, never from code."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tillmark.sources import schemas


def configure_object_store(
    spark: SparkSession,
    endpoint: str | None = None,
    path_style: bool = True,
    ssl: bool = True,
) -> None:
    """Point ``s3a://`` reads of this session at an endpoint (``AWS_ENDPOINT_URL`` by default)."""
    endpoint = endpoint or os.environ.get("AWS_ENDPOINT_URL")
    settings = {
        "fs.s3a.path.style.access": str(path_style).lower(),
        "fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "fs.s3a.aws.credentials.provider": (
            "software.amazon.awssdk.auth.credentials.EnvironmentVariableCredentialsProvider"
        ),
    }
    if endpoint:
        settings["fs.s3a.endpoint"] = endpoint
    for key, value in settings.items():
        spark.conf.set(key, value)


def object_uri(uri: str) -> str:
    """``s3://`` addresses as Spark names them."""
    return uri.replace("s3://", "s3a://", 1) if uri.startswith("s3://") else uri


def read_dim(
    spark: SparkSession,
    location: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
) -> DataFrame:
    """A dimension table of a database (``jdbc:`` address) or of a folder of Parquet tables.

    User and password are read from ``TILLMARK_DB_USER`` and ``TILLMARK_DB_PASSWORD``.
    With ``split_column`` and ``bounds`` the table is read in parallel ranges.
    """
    if not location.startswith("jdbc:"):
        return spark.read.parquet(f"{location.rstrip('/')}/{table}")
    reader = spark.read.format("jdbc").option("url", location).option("dbtable", table)
    for option, variable in (("user", "TILLMARK_DB_USER"), ("password", "TILLMARK_DB_PASSWORD")):
        if variable in os.environ:
            reader = reader.option(option, os.environ[variable])
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def load_masters(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four typed master tables from ``root/<table>.csv``."""
    return {
        name: spark.read.schema(schema).option("header", "true").csv(f"{root.rstrip('/')}/{name}.csv")
        for name, schema in schemas.MASTERS.items()
    }
