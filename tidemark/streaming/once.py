"""Events once an id, by a state of hashed buckets of ids.

A processor keeps, for each bucket, its ids and when each is forgotten, in RocksDB: `keep` after the time of an id's first event, or
after the watermark where that is later. A timer of the bucket forgets those whose time has come, so the state is as large as the ids
of that span. A bucket's rows and ids are taken at once, so that the cost of a call is shared by all of them. Rows at the watermark or
behind it are left out. An id that comes again after it was forgotten is let in again. Rows without an id are one id, as with
dropDuplicates; those without a time are never late.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK, KEEP = "2 hours", 7_200_000
#: Buckets of ids: more for more ids at once.
BUCKETS = 512


class FirstOfId(StatefulProcessor):
    """The first row of each id of a bucket; `keep` milliseconds of event time later the id is forgotten."""

    def __init__(self, keep: int, id: str, time: str, schema: StructType):
        self.keep, self.id, self.time, self.columns = keep, id, time, schema.names
        self.kept = StructType().add("ids", ArrayType(schema[id].dataType)).add("ends", ArrayType(LongType()))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", self.kept)

    def _known(self) -> dict:
        held = self.seen.get()
        return {} if held is None else dict(zip(held[0], held[1], strict=True))

    def _keeps(self, known: dict) -> None:
        if known:
            self.seen.update((list(known), list(known.values())))
            self.handle.registerTimer(min(known.values()))
        else:
            self.seen.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark, known = timerValues.getCurrentWatermarkInMs(), self._known()
        before = len(known)
        for batch in rows:
            times = batch[self.time]
            batch = batch[times.isna() | (times > pd.Timestamp(watermark, unit="ms", tz=times.dt.tz))]  # Spark doesn't leave out late rows here
            batch = batch.drop_duplicates(self.id)
            ids = [None if missing else x for x, missing in zip(batch[self.id].tolist(), batch[self.id].isna(), strict=True)]
            new = [x not in known for x in ids]
            for x, at in ((x, at) for x, at, own in zip(ids, batch[self.time], new, strict=True) if own):
                known[x] = (watermark if pd.isna(at) else max(int(at.timestamp() * 1000), watermark)) + self.keep
            if any(new):
                yield batch.loc[new, self.columns]
        if len(known) > before:
            self._keeps(known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, due = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        self._keeps({x: end for x, end in self._known().items() if end > due and end >= watermark})
        yield from ()


def with_rocksdb(spark: SparkSession) -> None:
    """Has the session keep streams' state in RocksDB, which such a processor needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def once_an_id(events: DataFrame, delay: str = WATERMARK, keep: int = KEEP, id: str = "event_id", time: str = "ts") -> DataFrame:
    """The events of a stream, one for each id within `keep` milliseconds of event time; those later than the watermark are dropped."""
    bucket = "_bucket_of_" + "_".join(events.columns)  # no column of events
    marked = events.withWatermark(time, delay).withColumn(bucket, F.pmod(F.xxhash64(id), F.lit(BUCKETS)).cast("int"))
    return marked.groupBy(bucket).transformWithStateInPandas(statefulProcessor=FirstOfId(keep, id, time, events.schema), outputStructType=events.schema, outputMode="append", timeMode="EventTime")
