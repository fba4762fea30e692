"""Positions in a log, kept in a table, so that a bounded poll goes on where the last one ended."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.sources.tables import Table

SCHEMA = StructType([StructField("partition", IntegerType()), StructField("next", LongType())])
RETRIES, BACKOFF_SECONDS = 5, 0.5


def _furthest(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.select("partition", "next").unionByName(source).groupBy("partition").agg(F.max("next").alias("next"))


class Offsets:
    """The next offset of each partition of one topic. A commit never moves back, so one that is sent again does no harm."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = Table(spark, path, SCHEMA)

    def commit(self, records: DataFrame, retries: int = RETRIES, backoff: float = BACKOFF_SECONDS) -> None:
        """Everything up to the last of these records, of each partition, is done. No records, no change.

        Where another writer was faster, it is tried again, a little later each time.
        """
        done = records.where("offset >= 0").groupBy(F.col("partition").cast("int").alias("partition")).agg((F.max("offset") + 1).alias("next"))
        for attempt in range(retries + 1):
            try:
                self.table.merge(done, _furthest)
                return
            except RuntimeError:
                if attempt == retries:
                    raise
                time.sleep(backoff * (attempt + 1))

    def commit_ids(self, records: DataFrame, ids: DataFrame, key: str = "episode_id") -> None:
        """Commits up to the last record of the ids that were worked on, and no further."""
        self.commit(records.join(ids.select(key).distinct(), key, "left_semi"))

    def unread(self, records: DataFrame) -> DataFrame:
        """Records at or after their partition's next offset; all of a partition that has none."""
        at = self.table.read().select(F.col("partition").alias("_partition"), "next")
        joined = records.join(at, F.col("partition") == F.col("_partition"), "left")
        return joined.where(F.col("next").isNull() | (F.col("offset") >= F.col("next"))).drop("_partition", "next")
