"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tillmark.plans.catalog import QUERIES
from tillmark.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(found, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = canonical(result.fetchall(), names)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == expected
    assert expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_whole_table_is_replaced(spark, con):
    kept = QUERIES["replaced_table_whole"](spark, FOLDER)
    assert kept.count() == con.execute("SELECT count(*) FROM orders").fetchone()[0]


def test_stored_lookup_meets_all_bands(spark):
    found = QUERIES["stored_lookup_bands"](spark, FOLDER)
    assert {r.band_id for r in found.select("band_id").distinct().collect()} == set(range(20))


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
