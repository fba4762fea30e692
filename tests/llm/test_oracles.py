"""Queries against their SQL."""

import pytest
from oracle import connection, differences

from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, small, name):
    got, want, only_spark, only_sql = differences(queries.QUERIES[name](spark, small), connection(small), queries.ORACLE_SQL[name])
    assert (got, only_spark, only_sql) == (want, [], [])
