"""File sources: CSV unified by column name, notice parts, finance control, mirrors."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillmark.sources import schemas
from tillmark.staging import stage

R, T = TypeVar("R"), TypeVar("T")


def list_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``path, length`` of all files below ``root``; an error when there are none.

    Only the listing is read: the content column of the source is never selected.
    """
    found = list_with_times(spark, root, pattern).select("path", "length")
    if found.isEmpty():
        raise FileNotFoundError(f"no {pattern} files below {root}")
    return found


def list_with_times(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``path, length, modified`` and the ``file_path`` by which rows name their file (an escaped address)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("file_path"))
    )


def read_spread(spark: SparkSession, path: str, key: str, *columns: str, parts: int | None = None) -> DataFrame:
    """Parquet columns; with ``parts`` dealt into so many tasks by ``key``.

    Only the caller knows whether a table sits in too few row groups to use the cores, as the
    single-group test tables do; large tables split by themselves and need no shuffle.
    """
    df = spark.read.parquet(path).select(*columns)
    return df.repartition(parts, key) if parts else df


def read_union_by_name(
    spark: SparkSession, root: str, pattern: str = "*.csv", only: DataFrame | None = None
) -> DataFrame:
    """All CSV files below ``root`` as text columns, matched by header name, and ``file_path`` (an action).

    A column that a file lacks is NULL there; of two columns of one name in a file the first counts.
    Executors read the first record of each file, which may be of any length and hold quoted line
    breaks. One scan then reads the lines of all files by position, and the files' headers, a stored
    table, say by a join which position holds which name. The most common header needs no entry
    there, so files of one header need no join. Distinct headers reach the driver, since the plan
    names their columns; nothing that there is once a file does. Empty files are skipped. ``only``
    (column ``file_path``) limits the scan to some of the files.
    """
    settings = {k: v for k in ("endpoint", "connection.ssl.enabled") if (v := spark.conf.get(f"fs.s3a.{k}", None))}
    found = list_with_times(spark, root, pattern)
    if found.isEmpty():
        raise FileNotFoundError(f"no {pattern} files below {root}")
    if only is not None:
        found = found.join(only, "file_path", "left_semi")
    heads = stage(found.select("file_path").mapInPandas(_header_reader(settings), "file_path string, header string"), "headers")
    kinds = [
        (json.loads(r.header), r.header)
        for r in heads.where("header is not null").groupBy("header").count().orderBy(F.desc("count"), "header").collect()
    ]
    if not kinds:
        raise FileNotFoundError(f"only empty {pattern} files below {root}")
    number = F.lit(-1)
    for i, (_, header) in enumerate(kinds):
        number = F.when(F.col("header") == header, i).otherwise(number)
    numbered = heads.select("file_path", number.alias("_kind"))
    scans = {_breaks(names) for names, _ in kinds}
    parts = [_lines_of(spark, root, pattern, kinds, numbered, only, scan, len(scans) > 1) for scan in sorted(scans)]
    fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.casefold
    places: dict[str, tuple[str, dict[int, int]]] = {}
    for i, (names, _) in enumerate(kinds):
        for at, name in enumerate(n.strip() for n in names):
            places.setdefault(fold(name), (name, {}))[1].setdefault(i, at)

    def value(at: dict[int, int]) -> Column:
        where: dict[int, list[int]] = {}
        for kind, place in at.items():
            where.setdefault(place, []).append(kind)
        return F.coalesce(*[F.when(F.col("_kind").isin(ks), F.col(f"_c{place}")) for place, ks in where.items()])

    columns = [value(at).alias(name) for name, at in places.values()]
    return reduce(DataFrame.unionAll, [part.select(*columns, "file_path") for part in parts])


def _breaks(names: list[str]) -> bool:
    """Whether a header holds line breaks: the lines of such files may hold them too."""
    return any("\n" in name or "\r" in name for name in names)


def _lines_of(
    spark: SparkSession, root: str, pattern: str, kinds: list, numbered: DataFrame, only: DataFrame | None, multiline: bool, mixed: bool
) -> DataFrame:
    """Lines by position and the number of their file's header (``_kind``); in a ``mixed`` tree only those of one way to scan."""
    width = max(len(names) for names, _ in kinds)
    reader = (
        spark.read.schema(StructType([StructField(f"_c{i}", StringType()) for i in range(width)]))
        .option("header", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    )
    if multiline:
        reader = reader.option("multiLine", "true").option("escape", '"')
    lines = reader.csv(root).withColumn("file_path", F.col("_metadata.file_path"))
    if only is not None:
        lines = pick_files(lines, only)
    other = numbered.where("_kind <> 0")
    if other.isEmpty():
        return lines.withColumn("_kind", F.lit(0))
    lines = lines.join(other, "file_path", "left").withColumn("_kind", F.coalesce("_kind", F.lit(0)))
    wanted = [i for i, (names, _) in enumerate(kinds) if not mixed or multiline == _breaks(names)]
    return lines.where(F.col("_kind").isin(wanted))


def pick_files(rows: DataFrame, names: DataFrame, listed: int = 1000, picked: bool = True) -> DataFrame:
    """Rows whose ``file_path`` is among ``names`` (or, with ``picked=False``, is not).

    Up to ``listed`` names are written into the filter, so that other files are not opened; more
    are picked by a join.
    """
    few = names.select("file_path").distinct().limit(listed + 1).collect()
    if len(few) > listed:
        return rows.join(names.select("file_path").distinct(), "file_path", "left_semi" if picked else "left_anti")
    inside = F.col("file_path").isin([r.file_path for r in few])
    return rows.where(inside if picked else ~inside)


def _header_reader(settings: dict[str, str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Function that reads the first record of each file on the executors, as JSON.

    It is local to this one, so Spark ships its code: executors need no copy of the package.
    ``settings`` are those of the session's object store.
    """

    def first_record(path):
        import csv
        import io
        import json
        from urllib.parse import unquote

        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        rest = unquote(rest)
        if scheme == "file":
            source, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
        elif scheme in ("s3", "s3a") and settings.get("endpoint"):
            plain = settings.get("connection.ssl.enabled") == "false"
            host = settings["endpoint"].partition("://")[2] or settings["endpoint"]
            source = fs.S3FileSystem(endpoint_override=host, scheme="http" if plain else "https")
            name = rest.lstrip("/")
        else:
            source, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        with source.open_input_stream(name) as stream:
            text = io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline="")
            record = next(csv.reader(text), None)
        return json.dumps(record) if record else None

    def read(batches):
        for batch in batches:
            yield batch[["file_path"]].assign(header=batch["file_path"].map(first_record))

    return read


def read_sales(
    spark: SparkSession, root: str, formats: tuple[str, ...] = ("csv", "parquet"), only: DataFrame | None = None
) -> DataFrame:
    """Raw sales lines of the landed files, every column text, plus ``file_path``.

    ``formats=("csv",)`` leaves the Parquet days out; ``only`` (column ``file_path``) all files but some.
    """
    parts = []
    for suffix in formats:
        found = list_with_times(spark, root, f"*.{suffix}")
        if only is not None:
            found = found.join(only, "file_path", "left_semi")
        if found.isEmpty():
            continue
        if suffix == "csv":
            parts.append(read_union_by_name(spark, root, only=only))
        else:
            lines = _parquet_as_text(spark, root)
            parts.append(lines if only is None else pick_files(lines, only))
    if not parts:
        raise FileNotFoundError(f"no {'/'.join(formats)} sales files below {root}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _parquet_as_text(spark: SparkSession, root: str) -> DataFrame:
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", "true")
        .parquet(root)
    )
    texts = [F.col(name).cast("string").alias(name) for name in raw.columns]
    return raw.select(*texts, F.col("_metadata.file_path").alias("file_path"))


def read_finance(spark: SparkSession, path: str) -> DataFrame:
    """Signed-off monthly revenue."""
    return spark.read.schema(schemas.FINANCE).option("header", "true").csv(path)


def read_labelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LABELLED_PAIRS).option("header", "true").csv(path)


NOTICE = ("notice_id", "body", "portal_id", "published_at")


def read_notices(spark: SparkSession, root: str) -> DataFrame:
    """``notice_id, body, portal_id, published_at`` of all CSV and Parquet parts, as text.

    A part may lack the portal or the date: NULL there.  Bodies that are NULL are left out.
    One id may occur more than once; ``plans.notices.unique_notices`` settles that.
    """
    parts = []
    for suffix in ("csv", "parquet"):
        try:
            list_files(spark, root, f"*.{suffix}")
        except FileNotFoundError:
            continue
        parts.append(_notice_part(spark, root, suffix))
    if not parts:
        raise FileNotFoundError(f"no notice parts below {root}")
    both = reduce(lambda a, b: a.unionByName(b), parts)
    return both.where(F.col("body").isNotNull())


def _notice_part(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}")
    if suffix == "csv":
        # Bodies hold line breaks and doubled quotes; columns are taken by name.
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", '"')
        part = reader.csv(root)
    else:
        part = reader.option("mergeSchema", "true").parquet(root)
    have = [F.col(c) if c in part.columns else F.lit(None) for c in NOTICE]
    return part.select(*[c.cast("string").alias(name) for c, name in zip(have, NOTICE, strict=True)])


def filter_partition(df: DataFrame, store: str, year: int, month: int) -> DataFrame:
    """One store-month of a landed tree; only its folder is read."""
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("store") == store))


def read_with_fallback(
    read: Callable[[str], R], primary: str, mirror: str, use: Callable[[R], T] | None = None
) -> R | T:
    """``read(primary)``, or ``read(mirror)`` when the primary cannot be read.

    ``use`` is what is done with the result, a write for one.  A file that turns out to be
    unreadable while ``use`` runs leads to the mirror too; any other failure in it, such as a
    full target, is raised: it says nothing about the source.
    """
    try:
        found = read(primary)
    except (PySparkException, Py4JJavaError, OSError) as failure:
        if not _is_read_failure(failure):
            raise
        found = read(mirror)
        return use(found) if use else found
    if use is None:
        return found
    try:
        return use(found)
    except (PySparkException, Py4JJavaError) as failure:
        if not _is_unreadable_file(failure):
            raise
        return use(read(mirror))


def unreadable_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``file_path`` of the Parquet files below ``root`` that cannot be decoded from their first row group to their last.

    Each file is opened by the task that holds its bytes; a daily file fits one task.
    """

    def broken(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            bad = []
            for path, content in zip(batch.column("file_path").to_pylist(), batch.column("content")):
                try:
                    for _ in pq.ParquetFile(pa.BufferReader(content.as_buffer())).iter_batches():
                        pass
                except (pa.ArrowException, OSError, ValueError):
                    bad.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], ["file_path"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(F.col("_metadata.file_path").alias("file_path"), "content").mapInArrow(broken, "file_path string")


def read_files_with_fallback(spark: SparkSession, primary: str, mirror: str, schema: str, listed: int = 1000) -> DataFrame:
    """Parquet rows of ``primary``; files that are unreadable or missing there come from ``mirror`` (an action).

    Both trees hold the same relative paths (``key=value`` folders become columns). Only the
    files in question are read from the mirror: up to ``listed`` of them are named in the scan,
    more are picked by a join on the file's path. ``from_mirror`` tells where a row comes from.
    """
    def relative(path: Column, root: str) -> Column:
        return F.regexp_extract(path, "/" + re.escape(root.rstrip("/").rsplit("/", 1)[1]) + "/(.*)$", 1)

    def names(root: str) -> DataFrame:
        return list_with_times(spark, root, "*.parquet").select(relative(F.col("file_path"), root).alias("file_path"))

    have, want = names(primary), names(mirror)
    broken = unreadable_files(spark, primary).select(relative(F.col("file_path"), primary).alias("file_path"))
    lost = stage(broken.union(want.join(have, "file_path", "left_anti")).join(want, "file_path", "left_semi").distinct(), "lost")

    def rows(root: str, from_mirror: bool) -> DataFrame:
        reader = spark.read.schema(schema).option("basePath", root).option("ignoreCorruptFiles", "true")
        found = reader.parquet(root).withColumn("file_path", relative(F.col("_metadata.file_path"), root))
        return pick_files(found, lost, listed, from_mirror).drop("file_path").withColumn("from_mirror", F.lit(from_mirror))

    return rows(primary, False).unionByName(rows(mirror, True))


def _is_unreadable_file(failure: Exception) -> bool:
    """Spark's error class for a source file, under whatever exception it arrives."""
    return "[FAILED_READ_FILE" in str(failure)


def _is_read_failure(failure: Exception) -> bool:
    if isinstance(failure, OSError) or _is_unreadable_file(failure):
        return True
    if isinstance(failure, AnalysisException):
        return failure.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
    causes = ("java.io.FileNotFoundException", "java.net.UnknownHostException", "java.net.ConnectException")
    return any(cause in str(failure) for cause in causes)
