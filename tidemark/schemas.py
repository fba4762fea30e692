"""Schemas of the application's tables and messages."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DateType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "array<float>": ArrayType(FloatType()),
}


def _struct(fields: str) -> StructType:
    """A struct of "name type" pairs; unlike Spark's own parser it needs no session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in fields.split(","))])


USER_EVENT = _struct(
    "event_id string, user_id string, episode_id string, event string, rating int, device string, ts string, "
    "position_sec int, from_sec int, to_sec int, played_pct double, bucket string"
)
RAW_EVENT = _struct("ts timestamp, user_id string, episode_id string, event string, rating int, event_id string, device string, day date")
DAILY_ENGAGEMENT = _struct("user_id string, episode_id string, day date, engagement double, num_events long, last_ts timestamp, created_at timestamp, updated_at timestamp")
USER_HISTORY = _struct("user_id string, episode_id string, first_seen_at timestamp, last_seen_at timestamp")
EPISODE = _struct(
    "episode_id string, podcast_title string, podcast_author string, podcast_url string, episode_title string, description string, audio_url string, json_str string"
)
TRANSCRIPT = _struct(
    "episode_id string, transcript string, failed boolean, error string, duration double, language string, analyzed boolean, ingest_ts string, retry_count long"
)
VECTOR = _struct("episode_id string, date string, embedding array<float>, model string, created_at timestamp")
SIMILARITY = _struct("new_episode_id string, historical_episode_id string, similarity double, k int, model string, distance_embed double, created_at timestamp")
FINAL_RECOMMENDATION = _struct("user_id string, recommended_episode_id string, score double, generated_at timestamp")
USER = _struct("id string, name string, surname string, date_of_birth string, gender string")
EPISODE_MESSAGE = _struct("podcast_title string, podcast_author string, podcast_url string, episode_title string, description string, audio_url string, episode_id string")
