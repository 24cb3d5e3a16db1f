"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from repo_pulse.workload.oracles import ORACLES
from repo_pulse.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    frame = entry_points.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = [tuple(row[c] for c in columns) for row in frame.collect()]
    answer = tables.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in places) for row in answer.fetchall()]
    key = lambda row: tuple((value is None, str(value)) for value in row)
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert found


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.count() > 0 and "event_count" in rows.columns
