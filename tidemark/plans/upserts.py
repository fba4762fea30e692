"""Queries of tables, sinks, documents and work lists: each runs the operator itself over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import dashboard, ingest, merges
from tidemark.plans import adapters as A
from tidemark.plans.adapters import EVENTS_SQL, KNN_SQL, RATINGS_SQL
from tidemark.sources import documents, records, sinks
from tidemark.sources.tables import Table, shared_folder, tolerant_read

QUERIES, ORACLE_SQL = {}, {}
EARLY, LATE = "2024-06-01 00:00:00", "2024-06-02 00:00:00"


def query(sql: str):
    """Registers a query by its function's name."""

    def put(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return put


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_SEEN_SQL = f"""ev AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS ingest_ts, event_id % 3 = 0 AS incoming FROM events),
    side AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, incoming ORDER BY ingest_ts DESC NULLS FIRST, event_id DESC) = 1)"""


@query(f"WITH {_SEEN_SQL} SELECT user_id, event_id, ingest_ts FROM side QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingest_ts DESC NULLS FIRST, incoming DESC) = 1")
def merge_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of each user's last event, and a batch of others, where many days are equal and some unknown."""
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd")).alias("ingest_ts")
    rows = A.table(spark, sf_dir, "events").select("user_id", "event_id", day)
    target, source = (merges.latest(rows.where(own), ["user_id"], "ingest_ts", "event_id") for own in ("event_id % 3 <> 0", "event_id % 3 = 0"))
    return merges.keep_latest(["user_id"])(target, source)


@query(
    f"""WITH p AS (SELECT CAST(page_id AS VARCHAR) AS episode_id, regexp_extract(html, '<title>([^<]*)', 1) AS episode_title, page_id FROM pages)
    SELECT episode_id, CASE WHEN page_id % 2 = 0 THEN 'new: ' || episode_title ELSE episode_title END AS episode_title,
      CASE WHEN page_id % 2 = 0 AND page_id % 4 <> 0 THEN TIMESTAMP '{LATE}' ELSE TIMESTAMP '{EARLY}' END AS created_at,
      CASE WHEN page_id % 2 = 0 THEN TIMESTAMP '{LATE}' ELSE TIMESTAMP '{EARLY}' END AS updated_at FROM p WHERE page_id % 2 = 0 OR page_id % 3 = 0"""
)
def merge_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page is known, every second one comes; of these each other one says when it was made."""
    pages = A.table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("episode_id"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("episode_title"))
    target = pages.where("page_id % 3 = 0").select("episode_id", "episode_title", _time(EARLY).alias("created_at"), _time(EARLY).alias("updated_at"))
    made = F.when(F.col("page_id") % 4 == 0, _time(EARLY)).otherwise(_time(LATE))
    source = pages.where("page_id % 2 = 0").select("episode_id", F.concat(F.lit("new: "), "episode_title").alias("episode_title"), made.alias("created_at"))
    return merges.upsert_episodes(_time(LATE))(target, source)


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def append_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers appended in two halves, of which only the second has a segment."""
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    table = Table(spark, _folder(spark, "evolved"), StructType.fromDDL("id long, name string"))
    table.append(rows.where("id % 2 = 1").drop("segment"))
    table.append(rows.where("id % 2 = 0"))
    return table.read()


@query("SELECT DISTINCT coalesce(nullif(regexp_extract(url, '(\\d+)', 1), ''), url) AS episode_id FROM pages")
def compacted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.known_ids(A.table(spark, sf_dir, "pages").select(F.col("url").cast("binary").alias("key")))


@query("SELECT page_id, url FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)")
def unseen_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = A.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    return ingest.unseen(A.table(spark, sf_dir, "pages").select("page_id", "url"), known.union(known), "page_id")


@query(
    """WITH r AS (SELECT CAST(page_id AS VARCHAR) AS episode_id, url AS audio_url, page_id % 3 AS retry_count FROM pages WHERE page_id % 2 = 0),
    first AS (SELECT episode_id, audio_url, 0 AS priority FROM r ORDER BY retry_count, episode_id LIMIT 5),
    new AS (SELECT CAST(page_id AS VARCHAR) AS episode_id, url AS audio_url, 1 AS priority FROM pages WHERE page_id % 3 = 0)
    SELECT episode_id, audio_url, CAST(priority AS INTEGER) AS priority FROM (SELECT * FROM first UNION ALL SELECT * FROM new) QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY priority, audio_url) = 1"""
)
def retry_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five retries, of every second page, and then every third page."""
    pages = A.table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("episode_id"), F.col("url").alias("audio_url"), (F.col("page_id") % 3).alias("retry_count"))
    return ingest.worklist(pages.where("page_id % 2 = 0"), pages.where("page_id % 3 = 0"))


@query("SELECT CAST(doc_id AS VARCHAR) AS episode_id, trim(text) AS transcript, lang AS date FROM documents WHERE length(trim(coalesce(text, ''))) > 0 AND lang = 'de' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that have no label yet, of one value of their date column, for which the language stands."""
    transcripts = A.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"), F.col("text").alias("transcript"), F.col("lang").alias("date"))
    done = A.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("episode_id"))
    return ingest.pending(transcripts, done, "de")


@query(f"WITH {RATINGS_SQL} SELECT user_id, episode_id, round(engagement, 6) AS als_score FROM ratings WHERE CAST(user_id AS BIGINT) % 5 <> 0")
def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores as texts in documents with other fields, some of which aren't numbers."""
    from tidemark.operators import recommend

    score = F.when(F.col("user_id").cast("long") % 5 == 0, "n/a").otherwise(F.round("engagement", 6).cast("string"))
    rated = recommend.ratings(A.daily(spark, sf_dir)).select("user_id", "episode_id", score.alias("als_score"), F.lit("x").alias("_id"))
    return documents.scores(rated)


@query(f"WITH {KNN_SQL} SELECT new_episode_id, similarity, CAST(NULL AS VARCHAR) AS model FROM sims")
def found_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fields of the neighbours' documents, one of which none has."""
    return documents.found(A.similarities(spark, sf_dir), "new_episode_id", "similarity", "model")


@query("SELECT CAST(page_id AS VARCHAR) AS key, CAST(to_json({'page_id': page_id, 'url': url}) AS VARCHAR) AS value FROM pages")
def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.to_messages(A.table(spark, sf_dir, "pages").select("page_id", "url"), "page_id")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def sink_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to a store that is down, then to a table; and once more by a load that finds rows there and does nothing."""
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    table = Table(spark, _folder(spark, "fallback"), rows.schema)

    def down(_: DataFrame) -> None:
        raise ConnectionError("the store is down")

    sinks.first_that_works(rows.union(rows), [down, lambda df: sinks.load_once(df, table, "id")])
    sinks.load_once(rows.withColumn("name", F.lit("again")), table, "id")
    return table.read()


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer")
def tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is there, one that isn't."""
    at, form = _folder(spark, "tolerant"), StructType.fromDDL("id string, name string")
    A.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name")).write.parquet(f"{at}/there")
    found = [tolerant_read(spark, f"{at}/{x}", form) for x in ("there", "nowhere")]
    return found[0].union(found[1])


@query(
    f"""WITH {EVENTS_SQL}, latest AS (SELECT max(ts) AS m FROM ev) SELECT event_id, user_id, episode_id, event, rating, ts FROM ev, latest WHERE ts >= m - INTERVAL 1440 MINUTE"""
)
def trailing_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's window as SQL over a view of raw events by day, of which only the days in it are read."""
    at = _folder(spark, "raw")
    A.events(spark, sf_dir).withColumn("day", F.to_date("ts")).drop("position_sec").write.partitionBy("day").parquet(at)
    return dashboard.trailing_by_sql(spark, dashboard.as_view(spark.read.parquet(at), "raw_user_events"), A.MINUTES)
