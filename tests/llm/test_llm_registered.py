"""The registered queries beside their SQL, and what is registered."""

import pytest

import __spark_entry__ as entry
from calltext.llm.oracles import ORACLES
from calltext.llm.queries import QUERIES
from checks.compare import connect, duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    columns, got = spark_rows(QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = duckdb_rows(connect(FOLDER), ORACLES[name])
    assert columns == wanted_columns and got == wanted and got
