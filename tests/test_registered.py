"""Every registered query gives the rows of its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, duckdb_rows, spark_rows
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, got = spark_rows(QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = duckdb_rows(con, ORACLES[name])
    assert columns == wanted_columns
    assert got == wanted
    assert got, "the fixture should give this query something to do"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["file_name", "permno", "match_type", "match_type_desc"]
    assert df.count() > 0
