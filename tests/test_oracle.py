"""Every registered query against its SQL twin."""

import pytest

from opsledger.catalog import all_queries, all_sql
from tests import oracle

QUERIES, SQL = all_queries(), all_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, oracle.folder("0.001")), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, oracle.folder("0.001")).count() >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
