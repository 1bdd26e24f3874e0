"""Every query of the subpackage that has SQL gives the same rows in both engines."""

import pytest
from checks import compare

from subscope.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, sf_dir, name):
    assert compare.differences(queries.queries()[name](spark, sf_dir), compare.connect(sf_dir), SQL[name]) == []


def test_there_is_a_query_for_every_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14)) and set(SQL) <= set(queries.queries())
