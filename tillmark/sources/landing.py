"""Landing of daily store files under ``year/month/store``."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmark.functions import scalars as S
from tillmark.sources.files import list_with_times, read_sales
from tillmark.staging import stage

LAYOUT = ("year", "month", "store")


def parse_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Store, year, month and business date of each file whose name fits; others are skipped."""
    name = F.col(path)
    return files.where(name.rlike(S.SALES_FILE)).select(
        "*",
        S.file_store(name).alias("store"),
        S.file_year(name).cast("int").alias("year"),
        S.file_month(name).cast("int").alias("month"),
        S.file_business_date(name).alias("file_date"),
    )


def land_partitioned(
    spark: SparkSession,
    source: str,
    target: str,
    formats: tuple[str, ...] = ("csv", "parquet"),
) -> DataFrame:
    """Land the raw lines of all matching files and return matched files per partition.

    The rebalance hint lets Spark merge the many small daily files of one store-month
    into few output files and split a store-month that is too large for one task.
    """
    lines = parse_names(read_sales(spark, source, formats), "file_path")
    (
        lines.hint("rebalance", *LAYOUT)
        .write.mode("overwrite")
        .partitionBy(*LAYOUT)
        .parquet(target)
    )
    return files_and_lines(spark.read.parquet(target))


MANIFEST = "file_path string, length long, modified timestamp"


def land_new(
    spark: SparkSession,
    source: str,
    target: str,
    formats: tuple[str, ...] = ("csv", "parquet"),
    manifest: str | None = None,
) -> DataFrame:
    """Land the files that are new or were sent again since the last run; ``year, month, store, files, lines`` of what was rewritten.

    A manifest beside the target (``<target>_manifest``) names every landed file with its length and
    time. Files that it does not hold are the fresh ones; only they are read from the source. Only
    the months they belong to are rewritten: what lies there from other files, and the fresh files'
    lines in place of their own earlier ones. Landed files that have left the source stay landed.
    Without fresh files nothing is written. The manifest is extended last, so a run that broke off
    is simply done again. Files whose names do not fit are skipped, and so are those of no bytes. One run at a time a target.
    """
    manifest = manifest or target.rstrip("/") + "_manifest"
    listed = [list_with_times(spark, source, f"*.{suffix}").select("file_path", "length", "modified") for suffix in formats]
    here = reduce(DataFrame.unionAll, listed).where(F.col("file_path").rlike(S.SALES_FILE))
    known = _read_or_none(spark, manifest, MANIFEST)
    if known is not None:
        here = here.join(known, ["file_path", "length", "modified"], "left_anti")
    fresh = stage(here, "fresh")
    if fresh.isEmpty():
        return spark.createDataFrame([], "year int, month int, store string, files long, lines long")
    touched = parse_names(fresh, "file_path").select(*LAYOUT).distinct()
    fresh_files = fresh.select("file_path")
    parts = []
    try:
        parts.append(parse_names(read_sales(spark, source, formats, fresh_files), "file_path"))
    except FileNotFoundError:  # no fresh file has a header
        pass
    landed = _read_or_none(spark, target)
    if landed is not None:
        few = F.broadcast(touched) if touched.count() <= 10_000 else touched
        parts.append(landed.join(few, list(LAYOUT), "left_semi").join(fresh_files, "file_path", "left_anti"))
    counts = touched.select("*", F.lit(0).cast("long").alias("files"), F.lit(0).cast("long").alias("lines"))
    if parts:
        lines = stage(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "landing")
        (
            lines.hint("rebalance", *LAYOUT)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*LAYOUT)
            .parquet(target)
        )
        counts = touched.join(files_and_lines(lines), list(LAYOUT), "left").na.fill(0, ["files", "lines"])
    counts = stage(counts, "counts")
    if landed is not None:
        _drop_folders(spark, target, counts.where("lines = 0"))
    fresh.write.mode("append").parquet(manifest)
    return counts


def files_and_lines(lines: DataFrame) -> DataFrame:
    """Number of files and lines of each store-month."""
    by_file = lines.groupBy(*LAYOUT, "file_path").agg(F.count("*").alias("file_lines"))
    return by_file.groupBy(*LAYOUT).agg(F.count("*").alias("files"), F.sum("file_lines").alias("lines"))


def _drop_folders(spark: SparkSession, target: str, emptied: DataFrame) -> None:
    """Delete the folders of months that lost all their lines: an overwrite by partition leaves them as they are."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for row in emptied.select(*LAYOUT).toLocalIterator():
        folder = jvm.Path(target.rstrip("/") + "".join(f"/{name}={row[name]}" for name in LAYOUT))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none yet."""
    reader = spark.read.option("mergeSchema", "true")
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return None
