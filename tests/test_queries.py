"""Every registered query against its plain SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def rows_of(records, columns):
    return sorted((tuple(r[c] for c in columns) for r in records), key=repr)


def test_names_match():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = entry_points.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    result = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = [dict(zip(names, r)) for r in result.fetchall()]
    assert sorted(names) == columns
    found = [r.asDict() for r in frame.collect()]
    assert found, "no rows"
    assert rows_of(found, columns) == rows_of(expected, columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
