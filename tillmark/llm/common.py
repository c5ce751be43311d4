"""Helpers that the operators of this package share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_ROOT = str(Path(__file__).resolve().parents[2])
Batches = Iterable[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (``bytes.split`` splits at just these); no text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8", "surrogatepass") if isinstance(data, str) else data).hexdigest()


def unused(columns: Iterable[str]) -> str:
    """A beginning that no name of ``columns`` has: what is named with it clashes with none of them."""
    taken, prefix = list(columns), "__"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def set_apart(docs: DataFrame, *kept: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but ``kept`` under names that clash with nothing, and the name of each column."""
    prefix = unused(docs.columns)
    names = {c: c if c in kept else f"{prefix}{i}" for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), names


def shipped(work: Callable) -> Callable:
    """``work`` in a form that tasks can load where the package lies only beside the driver's script."""
    packed, root = cloudpickle.dumps(work), _ROOT

    def run(*args):
        import sys

        from pyspark import cloudpickle

        if root not in sys.path:
            sys.path.append(root)
        return cloudpickle.loads(packed)(*args)

    return run


def map_batches(df: DataFrame, work: Callable[[Batches], Iterator[dict]], schema: str) -> DataFrame:
    """``work`` turns the Arrow batches of a partition into dicts of columns named as in ``schema``."""
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for made in work(batches):
            if made and len(next(iter(made.values()))):
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in kind], schema=kind)

    return df.mapInArrow(shipped(run), schema)


def each_batch(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``work`` on one Arrow batch after another."""

    def run(batches: Batches) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return map_batches(df, run, schema)
