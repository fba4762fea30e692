"""Podcast feeds, transcription and language, behind functions that the caller gives.

Network and models are the caller's: fetch, transcribe and detect run in Python workers, and
what they raise becomes a row's error rather than the job's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import languages

FEEDS, LONGEST_SECONDS = 50, 5400
FEED_SCHEMA = "feed_id string, feed_title string, feed_author string, feed_language string, episode_id string, title string, description string, audio_url string, published long"
TRANSCRIPT_SCHEMA = "episode_id string, transcript string, failed boolean, error string, duration double, language string"


def auth_headers(key: str, secret: str, now: int) -> dict[str, str]:
    """Headers of a request: the SHA-1 of key, secret and time, in hex."""
    return {"X-Auth-Key": key, "X-Auth-Date": str(now), "Authorization": hashlib.sha1(f"{key}{secret}{now}".encode()).hexdigest()}


def fetched(spark: SparkSession, fetch: Callable[[], list[dict]]) -> DataFrame:
    """Rows of FEED_SCHEMA that fetch returns, feeds with their episodes, and feed_rank, the feeds' order in that list."""
    listed = fetch()
    order = {feed: k for k, feed in enumerate(dict.fromkeys(row.get("feed_id") for row in listed))}
    return spark.createDataFrame([row | {"feed_rank": order[row.get("feed_id")]} for row in listed], FEED_SCHEMA + ", feed_rank long")


def english(language: Column, text: Column, detect: Callable[[str], str] | None = None) -> Column:
    """Whether a feed's language is en, or else its text is found to be. Detection that fails says no."""
    stated = F.lower(F.trim(language)) == "en"
    if detect is None:
        return F.coalesce(stated, F.lit(False))

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        def one(x):
            try:
                return detect(x) == "en"
            except Exception:
                return False

        return texts.fillna("").map(one).astype(bool)

    return F.coalesce(stated, F.lit(False)) | found(text)


def english_feeds(feeds: DataFrame, profiles: DataFrame, language: str = "en") -> DataFrame:
    """The rows of feeds that say they are of the language, or else whose titles and descriptions together are found to be."""
    said = F.coalesce(F.lower(F.trim("feed_language")) == language, F.lit(False))
    own = feeds.where(~said).select("feed_id", F.concat_ws(" ", "title", "description").alias("text"))
    found = languages.detected(own, profiles, "feed_id").where(F.col("language") == language).select("feed_id")
    return feeds.where(said).unionByName(feeds.where(~said).join(found, "feed_id", "left_semi").select(*feeds.columns))


def newest_episodes(feeds: DataFrame, detect: Callable[[str], str] | None = None, most: int = FEEDS, profiles: DataFrame | None = None) -> DataFrame:
    """The newest episode of each English feed, of the first `most` feeds in their order, where it has an audio address: a
    feed whose newest has none yields none. Feeds go by feed_rank, or by id where there is no such column.

    A feed that names no language is judged by detect, or else by learned profiles (languages.profiles), if either is given.
    """
    place = F.min("feed_rank") if "feed_rank" in feeds.columns else F.lit(0)
    chosen = feeds.groupBy("feed_id").agg(place.alias("_at")).orderBy("_at", "feed_id").limit(most).select("feed_id")
    own = feeds.join(chosen, "feed_id", "left_semi")
    own = english_feeds(own, profiles) if detect is None and profiles is not None else own.where(english(F.col("feed_language"), F.concat_ws(" ", "title", "description"), detect))
    newest = Window.partitionBy("feed_id").orderBy(F.desc("published"), "episode_id")
    latest = own.withColumn("_k", F.row_number().over(newest)).where("_k = 1")
    return latest.where(T.first_filled(F.col("audio_url")).isNotNull()).drop("_k", "feed_rank")


def transcribed(episodes: DataFrame, transcribe: Callable[[str], dict], longest: float = LONGEST_SECONDS) -> DataFrame:
    """A row of TRANSCRIPT_SCHEMA for each episode (episode_id, audio_url).

    transcribe(url) returns transcript, duration and language. A missing address, a duration over
    longest and anything raised make a failed row with an error and an empty transcript.
    """

    def one(episode_id: str | None, url: str | None) -> dict:
        row = {"episode_id": episode_id, "transcript": "", "failed": True, "error": None, "duration": None, "language": None}
        if not url:
            return row | {"error": "no audio address"}
        try:
            found = transcribe(url)
            duration = found.get("duration")
            if duration is not None and duration > longest:
                return row | {"error": f"longer than {longest:g} seconds", "duration": float(duration)}
            return row | {"transcript": found.get("transcript") or "", "failed": False, "duration": duration, "language": found.get("language")}
        except Exception as error:
            return row | {"error": f"{type(error).__name__}: {error}"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [one(a if isinstance(a, str) else None, b if isinstance(b, str) else None) for a, b in zip(batch["episode_id"], batch["audio_url"], strict=True)]
            yield pd.DataFrame(rows, columns=["episode_id", "transcript", "failed", "error", "duration", "language"])

    return episodes.select("episode_id", "audio_url").mapInPandas(run, TRANSCRIPT_SCHEMA)
