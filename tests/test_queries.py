"""Every query against its DuckDB SQL, or for rows where it has none."""

import pytest
from oracle import connection, differences

from tidemark import catalog


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equals_sql(spark, small, con, name):
    got, want, only_spark, only_sql = differences(catalog.QUERIES[name](spark, small), con, catalog.ORACLE_SQL[name])
    assert got == want
    assert (only_spark, only_sql) == ([], [])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_has_rows(spark, small, name):
    assert not catalog.QUERIES[name](spark, small).isEmpty()
