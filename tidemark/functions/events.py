"""Expressions on user events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the stream's engagement.
STREAM_WEIGHTS = {"like": 3.0, "complete": 2.0, "skip": -1.0}
RATING_BASE, PAUSE_SECONDS, PAUSE_MOST = 3.0, 600.0, 1.0
#: Weights of the dashboard, another table than the stream's.
DASHBOARD_WEIGHTS = {"like": 2.0, "complete": 3.0, "pause": 0.5, "rate": 1.0, "skip": -1.0}
LIKED_RATING = 4


def engagement() -> Column:
    """An event's weight in the stream, 0 at least: unknown events, skips and ratings up to 3 weigh nothing."""
    gains = {event: F.lit(weight) for event, weight in STREAM_WEIGHTS.items()}
    gains["rate"] = F.col("rating").cast("double") - RATING_BASE
    gains["pause"] = F.least(F.coalesce("position_sec", F.lit(0)) / PAUSE_SECONDS, F.lit(PAUSE_MOST))  # least() passes over nulls
    own = (F.when(F.col("event") == event, F.greatest(gain, F.lit(0.0))) for event, gain in gains.items())  # a null gain is 0, as greatest() passes over it
    return F.coalesce(*own, F.lit(0.0))


def dashboard_weight(weights: dict[str, float] | None = None) -> Column:
    """An event's weight on the dashboard; unmapped events weigh 0, and weights may be negative."""
    known = (weights or DASHBOARD_WEIGHTS).items()
    return F.coalesce(*(F.when(F.col("event") == event, F.lit(float(weight))) for event, weight in known), F.lit(0.0))


def positive_interest() -> Column:
    """Liked, completed, or rated LIKED_RATING or more."""
    return F.col("event").isin("like", "complete") | ((F.col("event") == "rate") & (F.col("rating") >= LIKED_RATING))


def parsed_timestamp(text: Column) -> Column:
    """An ISO time with a zone, its fraction cut to milliseconds; null if it can't be read."""
    cut = F.regexp_replace(text, r"(\.\d{3})\d+", "$1")
    return F.coalesce(F.try_to_timestamp(cut, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")), F.lit(None).cast("timestamp"))


def bucket_start(ts: Column, minutes: int) -> Column:
    """The start of ts's bucket of so many minutes, by the hour's own clock in UTC."""
    seconds = 60 * minutes
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds) * seconds)


def event_id(user_id: Column, bucket: Column) -> Column:
    """One id for each user and bucket, whenever it is made."""
    return F.sha1(F.concat(user_id, F.lit("|"), bucket))


def iso_utc(ts: Column) -> Column:
    """ts in UTC, with milliseconds and a Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
