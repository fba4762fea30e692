"""JSON records and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions import text as T
from tidemark.sources import json_arrays
from tidemark.sources.files import listed


def json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of JSON files, each an array, one object over any number of lines, or an object a line.

    The first character that isn't white space tells an array, which is read by ranges of bytes, however large it is. Of the
    others, a file whose every filled line is an object is read a line at a time; objects over lines are read whole. Items that
    aren't objects are dropped; an object without any of the schema's fields is a row of nulls. Files without a
    valid record give none, and an error is raised if no file has one.
    """
    files = json_arrays.first_characters(listed(spark, path))
    found = json_arrays.array_objects(files.where("first = '['")).select(F.col("item").alias("value"))
    others = [r["path"] for r in files.where("first <> '['").select("path").collect()]  # names, as the listing itself holds them
    found = found.unionAll(_objects_of(spark, others)) if others else found
    if found.isEmpty():
        raise ValueError(f"no valid record in {path}")
    return found.select(F.from_json("value", schema).alias("r")).select("r.*")


def _objects_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON texts of the objects of files that are no arrays, as value."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("value")).where("value <> ''")
    own = F.from_json("value", "map<string,string>").isNotNull() & F.col("value").startswith("{")
    kinds = lines.groupBy("file").agg(F.max(F.when(own, 0).otherwise(1)).alias("whole"))
    whole_files = kinds.where("whole = 1").select("file")
    by_line = lines.join(whole_files, "file", "left_anti").select("value")
    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.trim("value").alias("value")).join(whole_files, "file", "left_semi")
    # a file whose first line is an object has one a line, and some that are none; another is one object
    first = F.from_json(F.regexp_extract("value", r"^\s*([^\n]*)", 1), "map<string,string>").isNotNull()
    objects = texts.where(~first & F.col("value").startswith("{")).select("value")
    loose = lines.join(texts.where(first).select("file"), "file", "left_semi").where(own).select("value")
    return by_line.unionAll(objects).unionAll(loose)


def episodes_and_transcripts(records: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Episode and transcript rows of sample records (fields may be missing, or empty and then fall back)."""
    at = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    episodes = records.select(
        at("episode_id").cast("string").alias("episode_id"),
        at("podcast_title").alias("podcast_title"),
        at("podcast_author").alias("podcast_author"),
        T.host_prefix(at("audio_url")).alias("podcast_url"),
        at("episode_title").alias("episode_title"),
        T.first_filled(at("description"), at("podcast_description")).alias("description"),
        at("audio_url").alias("audio_url"),
        F.to_json(F.struct(*records.columns)).alias("json_str"),
    )
    transcripts = records.select(
        at("episode_id").cast("string").alias("episode_id"),
        T.first_filled(at("transcript"), at("text")).alias("transcript"),
        F.lit(False).alias("failed"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("double").alias("duration"),
        F.lit("en").alias("language"),
        F.lit(False).alias("analyzed"),
        F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("ingest_ts"),
        F.lit(0).cast("long").alias("retry_count"),
    )
    return episodes, transcripts


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Episode rows of messages (key, value as bytes or text). Bad JSON counts as {}, and the id falls back to the key."""
    value = F.col("value").cast("string")
    parsed = messages.withColumn("e", F.from_json(value, schemas.EPISODE_MESSAGE))
    fields = [c for c in schemas.EPISODE.names if c not in ("episode_id", "json_str")]
    rest = [c for c in messages.columns if c not in ("key", "value")]
    json_str = F.when(F.get_json_object(value, "$").isNotNull(), value).otherwise(F.lit("{}"))
    return parsed.select(T.first_filled(F.col("e.episode_id"), F.col("key").cast("string")).alias("episode_id"), *(F.col(f"e.{c}").alias(c) for c in fields), json_str.alias("json_str"), *rest)


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """key and value (JSON) of rows, as a Kafka sink takes them."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def valid_records(episodes: DataFrame) -> DataFrame:
    """Rows with an id and an audio address."""
    return episodes.where(T.first_filled(F.col("episode_id")).isNotNull() & T.first_filled(F.col("audio_url")).isNotNull())
