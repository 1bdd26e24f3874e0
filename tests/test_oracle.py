"""Every query with SQL gives the same rows in both engines, on whole tables."""

import pytest

from checks import compare, oracle, queries

SQL = oracle.oracle_sql()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, con, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
