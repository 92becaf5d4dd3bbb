"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks import queries
from checks.compare import duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_equals_sql(spark, name):
    assert spark_rows(spark, FOLDER, name) == duckdb_rows(FOLDER, contract.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) <= set(contract.oracle_sql()) & set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "SKU"
    assert df.count() > 0
