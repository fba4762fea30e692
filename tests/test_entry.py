"""The driver's entry points."""

import __spark_entry__ as entry

from tidemark import catalog


def test_queries_and_sql():
    found = entry.queries()
    assert set(catalog.QUERIES) <= set(found) and set(entry.oracle_sql()) <= set(found)


def test_flagship_query(spark):
    found = entry.entry(spark)
    assert found.columns == ["user_id", "recommended_episode_id", "score"] and found.count() > 0
