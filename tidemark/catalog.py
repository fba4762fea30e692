"""Every query of the engine, by name, and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import analytics, ingestion, streams, upserts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = analytics.QUERIES | ingestion.QUERIES | streams.QUERIES | upserts.QUERIES
ORACLE_SQL: dict[str, str] = analytics.ORACLE_SQL | ingestion.ORACLE_SQL | streams.ORACLE_SQL | upserts.ORACLE_SQL
