"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from stratavid.plans import catalog, oracle
from tests.compare import check, connect

SF_DIR = entry.SMOKE_DIR
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert check(spark, SF_DIR, name, QUERIES[name], ORACLE[name], con) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 10
