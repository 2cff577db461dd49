"""Every loan-book query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, duck
from loanbook.plans import catalog

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, small, con, name):
    assert compare(name, QUERIES[name](spark, small), con, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
