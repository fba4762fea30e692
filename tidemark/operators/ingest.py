"""Bounded ingestion: new records, retries, and the log's own bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T

MOST_RETRIES, RETRY_SLICE = 3, 5
#: Transcripts that a trial run embeds.
EMBED_LIMIT = 50


def unseen(df: DataFrame, known: DataFrame | None, key: str = "episode_id") -> DataFrame:
    """Rows whose key isn't known; all of them if there is no table of known ones."""
    return df if known is None else df.join(known.select(key).distinct(), key, "left_anti")


def known_ids(messages: DataFrame) -> DataFrame:
    """Distinct normalised keys of a compacted topic, as episode_id."""
    key = T.normalized_id(F.col("key").cast("string"))
    return messages.select(key.alias("episode_id")).where(F.col("episode_id").isNotNull()).distinct()


def embedded_by(vectors: DataFrame, model: str) -> DataFrame:
    """Ids that this model has embedded; another model's vectors don't count."""
    return vectors.where(F.col("model") == model).select("episode_id").distinct()


def earlier(vectors: DataFrame, model: str, day: str | None = None) -> DataFrame:
    """episode_id and embedding of this model's vectors; of days before one, if the table has dates and one is given."""
    own = vectors.where(F.col("model") == model)
    return (own.where(F.col("date") < day) if day and "date" in vectors.columns else own).select("episode_id", "embedding")


def pending(transcripts: DataFrame, done: DataFrame, day: str | None = None, most: int | None = None) -> DataFrame:
    """Transcripts with text that aren't embedded yet; of one day if the table has dates and one is asked for.

    most limits a run to that many, the first by id.
    """
    T.require(transcripts, "episode_id", "transcript")
    dated = ["date"] if "date" in transcripts.columns else []
    rows = transcripts.select(F.col("episode_id").cast("string").alias("episode_id"), T.cleaned(F.col("transcript")).alias("transcript"), *dated).where(F.length("transcript") > 0)
    rows = rows.join(done.select("episode_id").distinct(), "episode_id", "left_anti")
    rows = rows.where(F.col("date") == day) if day and dated else rows
    return rows if most is None else rows.orderBy("episode_id").limit(most)


def failed(transcripts: DataFrame) -> DataFrame:
    return transcripts.where("failed")


def retry_queue(transcripts: DataFrame, episodes: DataFrame, most: int = MOST_RETRIES) -> DataFrame:
    """Failed transcripts of known id with retries left, and their audio addresses; without one they wait."""
    own = transcripts.where(F.col("episode_id").isNotNull() & ~T.blank(F.col("episode_id").cast("string")))
    count = F.coalesce(F.col("retry_count").cast("string").try_cast("int"), F.lit(0))
    own = own.select(F.trim(F.col("episode_id").cast("string")).alias("episode_id"), F.col("failed"), count.alias("retry_count")).where(F.col("failed") & (F.col("retry_count") < most))
    joined = own.join(episodes.select(F.col("episode_id").cast("string").alias("episode_id"), "episode_title", "audio_url"), "episode_id", "left")
    return joined.where(T.first_filled(F.col("audio_url")).isNotNull()).select("episode_id", "retry_count", "episode_title", "audio_url")


def next_retry_count(failed: Column, before: Column, most: int = MOST_RETRIES) -> Column:
    return F.when(failed, F.least(before + 1, F.lit(most))).otherwise(before)


def worklist(retries: DataFrame, new: DataFrame, most: int = RETRY_SLICE) -> DataFrame:
    """The first retries, then what is new, each id once."""
    first = retries.orderBy("retry_count", "episode_id").limit(most).select("episode_id", "audio_url", F.lit(0).alias("priority"))
    both = first.unionByName(new.select("episode_id", "audio_url", F.lit(1).alias("priority")))
    rank = Window.partitionBy("episode_id").orderBy("priority", "audio_url")
    return both.withColumn("_k", F.row_number().over(rank)).where("_k = 1").drop("_k")


def first_wins(records: DataFrame, key: Column, arrival: str) -> DataFrame:
    """The first record by arrival of each key; records without one are dropped."""
    keyed = records.withColumn("_key", key).where(F.col("_key").isNotNull())
    rank = Window.partitionBy("_key").orderBy(arrival)
    return keyed.withColumn("_k", F.row_number().over(rank)).where("_k = 1").drop("_k", "_key")


def compacted(log: DataFrame, key: str = "key", offset: str = "offset") -> DataFrame:
    """The value of each key's last record."""
    last = F.max_by(F.struct(*[c for c in log.columns if c != key]), offset)
    return log.groupBy(key).agg(last.alias("r")).select(key, "r.*")


def highest_offsets(records: DataFrame, *by: str) -> DataFrame:
    """The last offset of each partition, or id, or whatever else `by` names."""
    return records.groupBy(*by).agg(F.max("offset").alias("offset"))


def tail(records: DataFrame, a_partition: int = 20, most: int = 20) -> DataFrame:
    """The first `most` records, by partition and offset, of the last few of each partition."""
    ends = records.groupBy("partition").agg((F.max("offset") - a_partition).alias("_end"))
    return records.join(ends, "partition").where("offset > _end").drop("_end").orderBy("partition", "offset").limit(most)


def poll_until_new(records: DataFrame, known: DataFrame, size: int, attempts: int = 3, key: str = "episode_id") -> DataFrame:
    """What a bounded poll takes from a log of offset and key: batches of `size` offsets, up to the first that holds
    an unknown id, `attempts` at most. Every record read is returned, with is_new for unknown ids.
    """
    first = records.agg(F.min("offset").alias("o")).first()["o"]
    if first is None:
        return records.withColumns({"attempt": F.lit(0), "is_new": F.lit(False)})
    read = records.withColumn("attempt", F.floor((F.col("offset") - F.lit(first)) / size).cast("int")).where(F.col("attempt") < attempts)
    seen = known.select(F.col(key).alias("_known")).distinct()
    marked = read.join(seen, F.col(key) == F.col("_known"), "left").withColumn("is_new", F.col("_known").isNull() & F.col(key).isNotNull()).drop("_known")
    stop = marked.where("is_new").agg(F.min("attempt").alias("a")).first()["a"]
    return marked if stop is None else marked.where(F.col("attempt") <= stop)


def distinct_ids(new: DataFrame, old: DataFrame) -> DataFrame:
    """Distinct ids of new_episode_id and historical_episode_id; empty ones and "null" are no ids."""
    if new is old:  # one table's ids of both kinds, computed once
        both = new.select(F.explode(F.array("new_episode_id", "historical_episode_id")).alias("episode_id"))
    else:
        both = new.select(F.col("new_episode_id").alias("episode_id")).union(old.select("historical_episode_id"))
    return both.where(~F.col("episode_id").isin("", "null")).distinct()
