"""What the dashboard shows, as DataFrames."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import events as E

MINUTES, TOP, VOTES = 30, 20, 5


def trailing(events: DataFrame, minutes: int = MINUTES, now: str | None = None) -> DataFrame:
    """Events of the last minutes before the latest one, in order of time; before now if there are none.

    The bound is a scalar that the scan gets as a filter, on the partition column too if day is one.
    """
    bound = events.agg(F.max("ts")).first()[0]
    end = F.lit(bound) if bound is not None else (F.lit(now) if now else F.current_timestamp())
    least = end.cast(events.schema["ts"].dataType) - F.make_dt_interval(mins=F.lit(minutes))
    found = events.where(F.col("ts") >= least)
    if "day" in events.columns:
        found = found.where(F.col("day") >= F.to_date(least))
    return found.orderBy("ts", "event_id")


def as_view(events: DataFrame, name: str) -> str:
    """The name by which SQL of this session finds the rows."""
    events.createOrReplaceTempView(name)
    return name


def trailing_by_sql(spark: SparkSession, view: str, minutes: int = MINUTES) -> DataFrame:
    """trailing() as SQL over a view of raw events that is partitioned by day: only the days of the window are read.

    The last time is looked for in the last day alone. A table without rows gives none.
    """
    last = spark.sql("SELECT max(ts) AS ts FROM IDENTIFIER(:view) WHERE day = (SELECT max(day) FROM IDENTIFIER(:view))", args={"view": view}).first()["ts"]
    bound = {"view": view, "least": None if last is None else last - timedelta(minutes=minutes)}
    kind = spark.table(view).schema["ts"].dataType.simpleString()
    return spark.sql(
        f"""SELECT event_id, user_id, episode_id, event, rating, ts FROM IDENTIFIER(:view)
        WHERE day >= to_date(CAST(:least AS {kind})) AND ts >= CAST(:least AS {kind}) ORDER BY ts, event_id""",
        args=bound | {"least": None if last is None else str(bound["least"])},
    )


def typed(events: DataFrame) -> DataFrame:
    """Events of a raw table with their types as far as values can be read; an empty rating is null."""
    return events.withColumns({"ts": F.col("ts").try_cast("timestamp"), "rating": F.nullif(F.col("rating").cast("string"), F.lit("")).try_cast("int")})


def episode_titles(episodes: DataFrame) -> DataFrame:
    """Distinct pairs of id and title; an id of two titles has two rows."""
    return episodes.select(F.col("episode_id").cast("string").alias("episode_id"), "episode_title").distinct()


def titled(rows: DataFrame, titles: DataFrame, key: str = "episode_id") -> DataFrame:
    """rows with episode_title, their id where no title is known."""
    names = titles.select(F.col("episode_id").alias("_id"), F.col("episode_title").alias("_title"))
    return rows.drop("episode_title").join(names, F.col(key) == F.col("_id"), "left").withColumn("episode_title", F.coalesce("_title", key)).drop("_id", "_title")


def per_minute(events: DataFrame) -> DataFrame:
    """Events a minute; minutes without any are absent."""
    return events.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(F.count(F.lit(1)).alias("events"))


def engagement_top(events: DataFrame, k: int = TOP, weights: dict[str, float] | None = None) -> DataFrame:
    """Titles of the most weighted engagement, then most events, then in order; one aggregation for both figures."""
    by = events.groupBy("episode_title").agg(F.sum(E.dashboard_weight(weights)).alias("engagement"), F.count(F.lit(1)).alias("events"))
    return by.orderBy(F.desc("engagement"), F.desc("events"), "episode_title").limit(k)


def top_rated(events: DataFrame, votes: int = VOTES, k: int = TOP) -> DataFrame:
    """Titles by weighted rating: each mean is drawn to the mean of all ratings by the weight of `votes` ratings."""
    rated = events.where("event = 'rate'").withColumn("rating", F.col("rating").cast("double")).dropna(subset=["rating"])
    mean = rated.agg(F.avg("rating")).first()[0]
    by = rated.groupBy("episode_title").agg(F.avg("rating").alias("mean_rating"), F.count("rating").alias("votes"))
    v = F.col("votes")
    weighted = v / (v + votes) * F.col("mean_rating") + F.lit(votes) / (v + votes) * F.lit(mean)
    return by.withColumn("weighted_rating", F.round(weighted, 6)).orderBy(F.desc("weighted_rating"), F.desc("votes"), "episode_title").limit(k)


def kpis(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(F.countDistinct("user_id").alias("users"), F.round(F.avg("score"), 6).alias("mean_score"))


def most_liked(events: DataFrame) -> DataFrame:
    """The title of the most likes, the first in order of equal ones."""
    likes = events.where("event = 'like'").groupBy("episode_title").agg(F.count(F.lit(1)).alias("likes"))
    return likes.orderBy(F.desc("likes"), "episode_title").limit(1)


def best_for_users(recommendations: DataFrame, users: DataFrame, k: int = TOP) -> DataFrame:
    """Each user's best recommendation with their name, the k best overall, by surname and name.

    Users without a name or surname, and rows without a score, are left out.
    """
    best = Window.partitionBy("user_id").orderBy(F.desc_nulls_last("score"), "recommended_episode_id")
    first = recommendations.dropna(subset=["user_id", "score"]).withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k")
    named = users.where((F.trim("name") != "") & (F.trim("surname") != "")).select(F.col("id").alias("user_id"), "name", "surname")
    return first.join(named, "user_id").orderBy(F.desc("score"), "user_id").limit(k).orderBy("surname", "name", "user_id")
