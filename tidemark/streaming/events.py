"""The stream of user events: decoding, deduplication, and its two sinks."""

from __future__ import annotations

import signal
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import events as E
from tidemark.operators import engagement, merges
from tidemark.sources.tables import Table

WATERMARK, TRIGGER, FILES_A_TRIGGER = "2 hours", "30 seconds", 200
#: Buckets of users in the history: a batch rewrites those of its users only. More for more users.
HISTORY_BUCKETS = 256
DAILY_KEYS, HISTORY_KEYS = ["user_id", "episode_id", "day"], ["user_id", "episode_id"]


def daily_table(spark: SparkSession, path: str) -> Table:
    return Table(spark, path, schemas.DAILY_ENGAGEMENT, "day")


def history_table(spark: SparkSession, path: str, buckets: int = HISTORY_BUCKETS) -> Table:
    return Table(spark, path, schemas.USER_HISTORY, "user_id", buckets)


def file_stream(spark: SparkSession, path: str, files: int = FILES_A_TRIGGER) -> DataFrame:
    """Lines of JSON files as they come, as the value of messages."""
    return spark.readStream.option("maxFilesPerTrigger", files).text(path)


def decoded(messages: DataFrame) -> DataFrame:
    """Events of messages' JSON values, with ts as a timestamp. What can't be read is null."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schemas.USER_EVENT).alias("e")).select("e.*")
    return parsed.withColumn("ts", E.parsed_timestamp(F.col("ts")))


def deduplicated(events: DataFrame, delay: str = WATERMARK, bounded: bool = False) -> DataFrame:
    """Events once an id; those later than the watermark are dropped.

    By default an id is remembered for ever, since its time is no part of the key. bounded
    forgets ids once the watermark has passed, and lets one in again after that.
    """
    marked = events.withWatermark("ts", delay)
    return marked.dropDuplicatesWithinWatermark(["event_id"]) if bounded else marked.dropDuplicates(["event_id"])


def write_raw(events: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends raw events to Parquet files by day."""
    out = engagement.raw_projection(events).writeStream.format("parquet").outputMode("append").partitionBy("day").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def apply_batch(batch: DataFrame, batch_id: int, daily: Table, history: Table, writer: str = "user_events") -> None:
    """Merges one batch into daily engagement and history; a batch that is replayed changes neither."""
    batch = batch.persist()
    try:
        if not batch.isEmpty():
            daily.merge(engagement.daily(batch), merges.additive(DAILY_KEYS), writer, batch_id)
            history.merge(engagement.history_candidates(batch), merges.set_on_insert(HISTORY_KEYS), writer, batch_id)
    finally:
        batch.unpersist()


def write_engagement(events: DataFrame, daily: Table, history: Table, checkpoint: str, once: bool = False) -> StreamingQuery:
    out = events.writeStream.foreachBatch(lambda batch, n: apply_batch(batch, n, daily, history)).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out.trigger(processingTime=TRIGGER)).start()


def run(spark: SparkSession, source: DataFrame, raw: str, daily: Table, history: Table, checkpoints: str, once: bool = False) -> list[StreamingQuery]:
    """Both queries on one source, each with its own offsets and state."""
    events = deduplicated(decoded(source))
    return [write_raw(events, raw, f"{checkpoints}/raw", once), write_engagement(events, daily.ensure(), history.ensure(), f"{checkpoints}/engagement", once)]


def serve(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Waits until a query ends, fails or a signal comes, then stops all of them: what was committed is kept, and a batch that
    was cut off is replayed by the next start."""

    def stop(*_) -> None:
        raise KeyboardInterrupt

    before = signal.signal(signal.SIGTERM, stop) if threading.current_thread() is threading.main_thread() else None
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        spark.streams.resetTerminated()
        if before is not None:
            signal.signal(signal.SIGTERM, before)
