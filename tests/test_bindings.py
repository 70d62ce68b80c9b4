"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
