"""The application's inputs over the driver tables, and the same as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dashboard, engagement, knn, recommend

MINUTES, TOP_N, ALPHA, MODEL = 1440, 10, 0.7, "table"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events: the tables' event types stand for kinds of event, and props' k for the episode."""
    kind = F.col("event_type")
    named = F.when(kind == "purchase", "like").when(kind == "signup", "complete").when(kind == "view", "rate").when(kind == "click", "pause").when(kind == "error", "skip")
    device = F.get(F.array(F.lit("ios"), F.lit("android"), F.lit("web")), (F.col("event_id") % 3).cast("int"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("episode_id"),
        named.alias("event"),
        F.when(kind == "view", (1 + F.col("event_id") % 5).cast("int")).alias("rating"),
        F.when(kind == "click", F.floor(F.col("value") * 10).cast("int")).alias("position_sec"),
        device.alias("device"),
        "ts",
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("episode_id"), F.col("p_name").alias("episode_title"))


def titled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.titled(events(spark, sf_dir), dashboard.episode_titles(episodes(spark, sf_dir)))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("surname"))
    own = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return own.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), "surname", F.col("c_mktsegment").alias("gender"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")


def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knn.top_k(vectors(spark, sf_dir), None)
    return found.select(F.col("new_id").alias("new_episode_id"), F.col("historical_id").alias("historical_episode_id"), "similarity")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement.daily(events(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement.history_candidates(events(spark, sf_dir))


def hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = recommend.proxy_scores(recommend.ratings(daily(spark, sf_dir)))
    return recommend.hybrid(scores, similarities(spark, sf_dir), history(spark, sf_dir), ALPHA)


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ranked at the decimals that are shown, which hold 0.3 of a similarity exactly, so that the order of sums can't decide
    return recommend.top_n(hybrid(spark, sf_dir).withColumn("score", F.round("score", 8)), TOP_N).drop("generated_at")


EVENTS_SQL = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    nullif(regexp_extract(props, '"k":\\s*(\\d+)', 1), '') AS episode_id,
    CASE event_type WHEN 'purchase' THEN 'like' WHEN 'signup' THEN 'complete' WHEN 'view' THEN 'rate' WHEN 'click' THEN 'pause' WHEN 'error' THEN 'skip' END AS event,
    CASE WHEN event_type = 'view' THEN CAST(1 + event_id % 5 AS INTEGER) END AS rating,
    CASE WHEN event_type = 'click' THEN CAST(floor(value * 10) AS INTEGER) END AS position_sec,
    CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS device,
    ts, CAST(ts AS DATE) AS day
  FROM events)"""
WEIGHED_SQL = EVENTS_SQL + """, weighed AS (
  SELECT *, greatest(CASE WHEN event = 'like' THEN 3.0 WHEN event = 'complete' THEN 2.0 WHEN event = 'rate' THEN CAST(rating AS DOUBLE) - 3.0
    WHEN event = 'pause' THEN least(CAST(coalesce(position_sec, 0) AS DOUBLE) / 600.0, 1.0) WHEN event = 'skip' THEN -1.0 ELSE 0.0 END, 0.0)::DOUBLE AS weight
  FROM ev)"""
DAILY_SQL = WEIGHED_SQL + """, daily AS (
  SELECT user_id, episode_id, day, sum(weight) AS engagement, count(*) AS num_events, max(ts) AS last_ts FROM weighed GROUP BY ALL)"""
HISTORY_SQL = """history AS (
  SELECT user_id, episode_id, max(ts) AS last_ts FROM ev
  WHERE (event IN ('like', 'complete') OR (event = 'rate' AND rating >= 4)) AND user_id IS NOT NULL AND episode_id IS NOT NULL GROUP BY ALL)"""
TITLED_SQL = EVENTS_SQL + """, titles AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id, p_name AS title FROM part),
titled AS (SELECT ev.*, coalesce(title, episode_id) AS episode_title FROM ev LEFT JOIN titles ON id = episode_id)"""
KNN_SQL = """vectors AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
normed AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS n FROM vectors),
pairs AS (SELECT a.id AS new_episode_id, b.id AS historical_episode_id, round(list_dot_product(a.e, b.e) / ((a.n + 1e-8) * (b.n + 1e-8)), 6) AS similarity
  FROM normed a CROSS JOIN normed b WHERE a.n > 0),
nearest AS (SELECT *, row_number() OVER (PARTITION BY new_episode_id ORDER BY similarity DESC, historical_episode_id) AS rank FROM pairs QUALIFY rank <= 3),
sims AS (SELECT * FROM nearest WHERE new_episode_id <> historical_episode_id)"""
RATINGS_SQL = DAILY_SQL + """, ratings AS (
  SELECT user_id, episode_id, sum(engagement) AS engagement FROM daily WHERE engagement >= 0 GROUP BY ALL HAVING sum(engagement) > 1e-6)"""
CONTENT_SQL = """content AS (
  SELECT user_id, new_episode_id AS episode_id, max(similarity) AS sim_score FROM history JOIN sims ON episode_id = historical_episode_id GROUP BY ALL)"""
HYBRID_SQL = f"""{RATINGS_SQL}, {HISTORY_SQL}, {KNN_SQL}, {CONTENT_SQL},
als AS (SELECT user_id, episode_id, engagement / max(engagement) OVER (PARTITION BY user_id) AS als_score FROM ratings),
hybrid AS (SELECT als.user_id, als.episode_id AS recommended_episode_id, round(max(0.7::DOUBLE * als_score + (1 - 0.7::DOUBLE) * coalesce(sim_score, 0)), 8) AS score
  FROM als LEFT JOIN content USING (user_id, episode_id) GROUP BY ALL)"""
RECS_SQL = HYBRID_SQL + """, recs AS (
  SELECT user_id, recommended_episode_id, score FROM hybrid QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, recommended_episode_id) <= 10)"""
USERS_SQL = """users AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, n_name AS surname, c_mktsegment AS gender FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
