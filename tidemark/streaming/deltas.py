"""State of a stream as rows that batches append and reads add up.

Each batch writes what it has, by key, into a folder of its own, so that it writes in proportion to itself and not
to the table. Measures are commutative (sums, least and greatest), so a read is one aggregation over the folders, in
any order. A batch that is replayed writes its folder anew, with the same rows.

From time to time fold() adds up the folders of old batches into one table. Folders are deleted one fold later, when no
reader is left that listed them.

    path/batch=<n>/            rows of batch n
    path/folded/upto=<n>/      rows of all batches up to n
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import engagement

#: How a measure of several rows is one.
SUM, LEAST, MOST = "sum", "min", "max"


class Deltas:
    """Measures by keys, each with how it is added up. One stream writes it, with batch numbers that grow."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], measures: dict[str, str]) -> None:
        self.spark, self.path, self.schema, self.keys, self.measures = spark, path.rstrip("/"), schema, keys, measures
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _folders(self, inside: str, name: str) -> dict[int, str]:
        """Finished folders name=<n>, by n."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}{inside}/{name}=*/_SUCCESS")
        found = pattern.getFileSystem(self._conf).globStatus(pattern) or []
        folders = [x.getPath().getParent() for x in found]
        return {int(x.getName().partition("=")[2]): x.toString() for x in folders}

    def state(self) -> tuple[int, list[str]]:
        """The last batch that is folded (-1 if none is), and the folders that hold all rows."""
        folded = self._folders("/folded", "upto")
        upto = max(folded, default=-1)
        return upto, [folded[n] for n in folded if n == upto] + [x for n, x in sorted(self._folders("", "batch").items()) if n > upto]

    def append(self, rows: DataFrame, batch_id: int) -> bool:
        """Writes the rows of a batch, added up by key. False, and nothing is written, if the batch was folded already."""
        if batch_id <= self.state()[0]:
            return False
        self._added_up(rows).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return True

    def _added_up(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*(F.expr(f"{how}({c})").alias(c) for c, how in self.measures.items()))

    def read(self) -> DataFrame:
        """One row a key, over all batches; no rows where nothing was written."""
        folders = self.state()[1]
        rows = self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)
        return self._added_up(rows)

    def fold(self, keep: int = 0) -> int:
        """Adds up all batches but the last `keep` into one table; the last batch in it. What was folded before is deleted."""
        batches, folded = self._folders("", "batch"), self._folders("/folded", "upto")
        before = max(folded, default=-1)
        rest = sorted(n for n in batches if n > before)
        upto = rest[-1 - keep] if len(rest) > keep else before
        if upto > before:
            folders = [folded[n] for n in folded if n == before] + [batches[n] for n in rest if n <= upto]
            self._added_up(self.spark.read.schema(self.schema).parquet(*folders)).write.mode("overwrite").parquet(f"{self.path}/folded/upto={upto}")
            jvm = self.spark.sparkContext._jvm
            for old in [x for n, x in batches.items() if n <= before] + [x for n, x in folded.items() if n < before]:
                at = jvm.org.apache.hadoop.fs.Path(old)
                at.getFileSystem(self._conf).delete(at, True)
        return upto


def daily_deltas(spark: SparkSession, path: str) -> Deltas:
    schema = "user_id string, episode_id string, day date, engagement double, num_events long, last_ts timestamp, created_at timestamp, updated_at timestamp"
    return Deltas(spark, path, schema, ["user_id", "episode_id", "day"], {"engagement": SUM, "num_events": SUM, "last_ts": MOST, "created_at": LEAST, "updated_at": MOST})


def history_deltas(spark: SparkSession, path: str) -> Deltas:
    """The first and last batch of each pair, with the pair's time in it."""
    seen = "struct<batch:long,ts:timestamp>"
    return Deltas(spark, path, f"user_id string, episode_id string, first {seen}, last {seen}", ["user_id", "episode_id"], {"first": LEAST, "last": MOST})


def history_of(deltas: Deltas, monotone: bool = False) -> DataFrame:
    """user_id, episode_id, first_seen_at (the time in the first batch) and last_seen_at (that in the last one, even if it is earlier,
    unless monotone)."""
    first, last = F.col("first.ts"), F.col("last.ts")
    return deltas.read().select("user_id", "episode_id", first.alias("first_seen_at"), (F.greatest(first, last) if monotone else last).alias("last_seen_at"))


def append_batch(batch: DataFrame, batch_id: int, daily: Deltas, history: Deltas, now: Column | None = None) -> None:
    """One batch's engagement by day and its liked pairs, each appended; a batch that is replayed changes neither."""
    batch = batch.persist()
    try:
        if not batch.isEmpty():
            stamp = (now if now is not None else F.current_timestamp()).cast("timestamp")
            daily.append(engagement.daily(batch).withColumns({"created_at": stamp, "updated_at": stamp}), batch_id)
            seen = F.struct(F.lit(batch_id).cast("long").alias("batch"), F.col("last_ts").alias("ts"))
            history.append(engagement.history_candidates(batch).withColumns({"first": seen, "last": seen}), batch_id)
    finally:
        batch.unpersist()
