"""Sinks with guards and fallbacks, and the external connectors' options."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.text import coerced
from tidemark.sources import documents
from tidemark.sources.tables import Table

log = logging.getLogger(__name__)


def first_that_works(df: DataFrame, sinks: list[Callable[[DataFrame], None]]) -> int | None:
    """Writes df by the first sink that doesn't fail and returns its place; logs and returns None if all fail."""
    for k, sink in enumerate(sinks):
        try:
            sink(df)
            return k
        except Exception:
            log.exception("sink %d failed", k)
    return None


def load_once(df: DataFrame, table: Table, key: str) -> bool:
    """Loads df, one row a key, only into a table without rows."""
    if table.exists() and not table.read().isEmpty():
        return False
    table.overwrite(df.dropDuplicates([key]))
    return True


def overwrite_coerced(df: DataFrame, table: Table, schema: dict[str, str]) -> int:
    """Replaces a table by df in this form (see functions.text.coerced) and returns how many rows it has."""
    return table.overwrite(coerced(df, schema))


def snapshot(df: DataFrame, table: Table) -> None:
    table.overwrite(df)


def kafka_options(servers: str, topic: str, group: str, per_trigger: int = 200) -> dict[str, str]:
    """Options of a streaming scan from the earliest offsets, which tolerates lost data."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": "false", "kafka.group.id": group}


def kafka_stream(spark: SparkSession, **options: str) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything in a topic now. Needs the Kafka connector on the class path."""
    return spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("endingOffsets", "latest").load()


def kafka_write(messages: DataFrame, servers: str, topic: str) -> None:
    """key and value to a topic. Needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def mongo_read(spark: SparkSession, uri: str, database: str, collection: str, fields: documents.Fields | None = None) -> DataFrame:
    """A collection, or these fields of it, which the connector then asks for alone. Needs the MongoDB connector on the class path."""
    df = spark.read.format("mongodb").option("connection.uri", uri).option("database", database).option("collection", collection).load()
    return documents.projected(df, fields) if fields else df


def mongo_write(df: DataFrame, uri: str, database: str, collection: str, mode: str = "overwrite") -> None:
    """Needs the MongoDB connector on the class path."""
    df.write.format("mongodb").mode(mode).option("connection.uri", uri).option("database", database).option("collection", collection).save()
