"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest
from conftest import SF0001

import __spark_entry__ as E
from oracle_compare import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) - set(E._llm()[0]) == set(SQL) - set(E._llm()[1])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "jour"


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _, _ = compare(spark, con, name, QUERIES[name], SQL[name], SF0001)
    assert ok, msg
