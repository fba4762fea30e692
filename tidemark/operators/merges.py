"""Merges of a target and a source as DataFrames: how(target, source) for Table.merge.

Aggregation or an anti join on the key is one shuffle of each side; keys that are spread
over tasks need no row of the target on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def additive(keys: list[str], now: Column | None = None) -> Merge:
    """Adds engagement and num_events, takes the later last_ts; new rows get created_at, changed ones updated_at."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        stamp = now if now is not None else F.current_timestamp()
        new = source.withColumn("created_at", stamp).withColumn("updated_at", stamp)
        return (
            target.unionByName(new.select(*target.columns))
            .groupBy(*keys)
            .agg(F.sum("engagement").alias("engagement"), F.sum("num_events").alias("num_events"), F.max("last_ts").alias("last_ts"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
            .select(*target.columns)
        )

    return merge


def replace(keys: list[str]) -> Merge:
    """Source rows replace target rows of their key; other target rows stay."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source, allowMissingColumns=True)

    return merge


def insert_only(keys: list[str]) -> Merge:
    """Source rows of keys that the target lacks."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        return target.unionByName(source.join(target.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)

    return merge


def update_columns(keys: list[str], columns: list[str], insert: bool = True) -> Merge:
    """Of keys in both, only these columns are the source's (one row a key); of others, source rows are inserted."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        new = source.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_there"))
        updated = target.join(new, keys, "left").select(*(F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns))
        return insert_only(keys)(updated, source) if insert else updated

    return merge


def upsert_episodes(now: Column | None = None) -> Merge:
    """Replaces episodes by id; every source column is taken, created_at too, which is now where it is missing."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        stamp = now if now is not None else F.current_timestamp()
        if "created_at" not in source.columns:
            source = source.withColumn("created_at", stamp)
        return replace(["episode_id"])(target, source.withColumn("updated_at", stamp))

    return merge


def upsert_transcripts(insert: bool = True, now: Column | None = None) -> Merge:
    """Inserts new transcripts only; or, if not insert, updates transcript and updated_at of known ones too."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        stamped = source.withColumn("updated_at", now if now is not None else F.current_timestamp())
        return insert_only(["episode_id"])(target, stamped) if insert else update_columns(["episode_id"], ["transcript", "updated_at"])(target, stamped)

    return merge


def set_on_insert(keys: list[str], monotone: bool = False) -> Merge:
    """first_seen_at is set once; last_seen_at is always the source's last_ts, even an earlier one unless monotone."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        new = source.select(*keys, F.col("last_ts").alias("_ts"))
        last = F.greatest("_ts", "last_seen_at") if monotone else F.coalesce("_ts", "last_seen_at")
        return target.join(new, keys, "full").select(*keys, F.coalesce("first_seen_at", "_ts").alias("first_seen_at"), last.alias("last_seen_at"))

    return merge


def latest(df: DataFrame, keys: list[str], order: str = "ingest_ts", sequence: str | None = None) -> DataFrame:
    """The last row of each key by order; a null order counts as the latest, and later sequences win ties."""
    by = [F.desc_nulls_first(order), *([F.desc(sequence)] if sequence else [])]
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_k = 1").drop("_k")


def keep_latest(keys: list[str], order: str = "ingest_ts") -> Merge:
    """Both sides' rows, the latest of each key; of equal times the source's."""

    def merge(target: DataFrame, source: DataFrame) -> DataFrame:
        both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)), allowMissingColumns=True)
        return latest(both, keys, order, "_side").drop("_side")

    return merge
