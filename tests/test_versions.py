"""Tables that are replaced by a switch, and files read from a mirror one by one."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillmark.sources import files, tables


def test_a_failed_write_leaves_the_old_rows(spark):
    name = f"t_{uuid.uuid4().hex}"
    first = tables.publish_version(spark.range(100).withColumn("x", F.lit(1)), name)
    assert first.count() == 100
    broken = spark.range(100, numPartitions=4).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("half way"))).otherwise(F.lit(2)).cast("int"))
    with pytest.raises(Exception, match="half way"):
        tables.publish_version(broken, name)
    assert rows(spark.table(name).agg(F.count("*"), F.max("x"))) == [(100, 1)]
    again = tables.publish_version(spark.table(name).withColumn("x", F.col("x") + 4), name)
    assert rows(again.agg(F.count("*"), F.max("x"))) == [(100, 5)]


def test_old_versions_go(spark):
    name = f"t_{uuid.uuid4().hex}"
    held = [tables.publish_version(spark.range(n + 1), name, keep=2) for n in range(4)]
    assert held[-1].count() == 4 and held[-2].count() == 3
    assert len(spark.catalog.listTables(pattern=f"{name}__v*")) == 2
    with pytest.raises(ValueError):
        tables.publish_version(spark.range(1), name, keep=0)


def tree(spark, folder):
    spark.range(200).select("id", (F.col("id") % 5).cast("int").alias("part")).repartition("part").write.partitionBy("part").parquet(folder)


@pytest.mark.parametrize("listed", [1000, 0])
def test_only_unreadable_and_missing_files_come_from_the_mirror(spark, tmp_path, listed):
    main, mirror = tmp_path / "main" / "rows", tmp_path / "mirror" / "rows"
    tree(spark, str(mirror))
    tree(spark, str(main))
    for part in range(5):
        source = next((mirror / f"part={part}").glob("*.parquet"))
        own = next((main / f"part={part}").glob("*.parquet"))
        for crc in (main / f"part={part}").glob(".*.crc"):
            crc.unlink()
        data = source.read_bytes()
        own.unlink()
        if part == 1:
            (own.parent / source.name).write_bytes(data[: len(data) // 2])
        elif part == 2:
            (own.parent / source.name).write_bytes(b"PAR1" + b"\xff" * 60 + data[64:])
        elif part != 3:
            (own.parent / source.name).write_bytes(data)
    got = files.read_files_with_fallback(spark, str(main), str(mirror), "id long, part int", listed)
    assert rows(got) == sorted(((i, i % 5, i % 5 in (1, 2, 3)) for i in range(200)), key=repr)
    sound = files.read_files_with_fallback(spark, str(mirror), str(mirror), "id long, part int", listed)
    assert sound.where("from_mirror").isEmpty() and sound.count() == 200
