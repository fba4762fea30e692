"""Queries of merges, ingestion, field functions, chunks and generators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import events as E
from tidemark.functions import text as T
from tidemark.operators import embedding, engagement, ingest, languages, merges
from tidemark.plans import adapters as A
from tidemark.plans.adapters import EVENTS_SQL, HISTORY_SQL, KNN_SQL, WEIGHED_SQL
from tidemark.sources import audio, documents, feed_source, feeds, json_arrays, records, sinks, synthetic
from tidemark.sources.files import listed
from tidemark.sources.offsets import Offsets
from tidemark.sources.tables import Table, checkpointed, shared_folder

QUERIES, ORACLE_SQL = {}, {}
EARLY, LATE = "2024-06-01 00:00:00", "2024-06-02 00:00:00"


def query(sql: str | None = None):
    """Registers a query by its function's name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table's events (likes and skips) and those of a batch that is merged into it: together all events."""
    events = A.events(spark, sf_dir)
    old = F.col("event").isin("like", "skip")
    return events.where(old), events.where(~old)


def _stamped(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("created_at", _time(text)).withColumn("updated_at", _time(text))


_SIDES_SQL = WEIGHED_SQL + """, old AS (SELECT user_id, episode_id, day, sum(weight) AS engagement, count(*) AS num_events, max(ts) AS last_ts FROM weighed WHERE event IN ('like', 'skip') GROUP BY ALL),
new AS (SELECT user_id, episode_id, day, sum(weight) AS engagement, count(*) AS num_events, max(ts) AS last_ts FROM weighed WHERE event NOT IN ('like', 'skip') GROUP BY ALL)"""


@query(
    f"""WITH {_SIDES_SQL} SELECT user_id, episode_id, day, round(coalesce(old.engagement, 0) + coalesce(new.engagement, 0), 6) AS engagement,
    coalesce(old.num_events, 0) + coalesce(new.num_events, 0) AS num_events, greatest(old.last_ts, new.last_ts) AS last_ts,
    CASE WHEN old.num_events IS NULL THEN TIMESTAMP '{LATE}' ELSE TIMESTAMP '{EARLY}' END AS created_at,
    CASE WHEN new.num_events IS NULL THEN TIMESTAMP '{EARLY}' ELSE TIMESTAMP '{LATE}' END AS updated_at
    FROM old FULL JOIN new USING (user_id, episode_id, day)"""
)
def merge_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _halves(spark, sf_dir)
    merged = merges.additive(["user_id", "episode_id", "day"], _time(LATE))(_stamped(engagement.daily(old), EARLY), engagement.daily(new))
    return merged.withColumn("engagement", F.round("engagement", 6))


@query(f"WITH {_SIDES_SQL} SELECT user_id, episode_id, day, num_events FROM new UNION ALL SELECT user_id, episode_id, day, num_events FROM old ANTI JOIN new USING (user_id, episode_id, day)")
def merge_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (engagement.daily(x).select("user_id", "episode_id", "day", "num_events") for x in _halves(spark, sf_dir))
    return merges.replace(["user_id", "episode_id", "day"])(old, new)


@query(f"WITH {_SIDES_SQL} SELECT user_id, episode_id, day, num_events FROM old UNION ALL SELECT user_id, episode_id, day, num_events FROM new ANTI JOIN old USING (user_id, episode_id, day)")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (engagement.daily(x).select("user_id", "episode_id", "day", "num_events") for x in _halves(spark, sf_dir))
    return merges.insert_only(["user_id", "episode_id", "day"])(old, new)


@query(
    f"""WITH {_SIDES_SQL} SELECT user_id, episode_id, day, coalesce(old.num_events, new.num_events) AS num_events, coalesce(new.last_ts, old.last_ts) AS last_ts
    FROM old FULL JOIN new USING (user_id, episode_id, day)"""
)
def merge_update_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (engagement.daily(x).select("user_id", "episode_id", "day", "num_events", "last_ts") for x in _halves(spark, sf_dir))
    return merges.update_columns(["user_id", "episode_id", "day"], ["last_ts"])(old, new)


@query(
    f"""WITH {EVENTS_SQL}, liked AS (SELECT *, CASE WHEN event IN ('like', 'skip') THEN 0 ELSE 1 END AS side FROM ev WHERE (event IN ('like', 'complete') OR (event = 'rate' AND rating >= 4)) AND episode_id IS NOT NULL),
    old AS (SELECT user_id, episode_id, max(ts) AS a FROM liked WHERE side = 0 GROUP BY ALL), new AS (SELECT user_id, episode_id, max(ts) AS b FROM liked WHERE side = 1 GROUP BY ALL)
    SELECT user_id, episode_id, coalesce(a, b) AS first_seen_at, coalesce(b, a) AS last_seen_at FROM old FULL JOIN new USING (user_id, episode_id)"""
)
def merge_set_on_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (engagement.history_candidates(x) for x in _halves(spark, sf_dir))
    target = old.select("user_id", "episode_id", F.col("last_ts").alias("first_seen_at"), F.col("last_ts").alias("last_seen_at"))
    return merges.set_on_insert(["user_id", "episode_id"])(target, new)


_LATEST_SQL = "CASE WHEN event = 'skip' THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M') END"


@query(
    f"""WITH {EVENTS_SQL}, r AS (SELECT user_id, episode_id, event, {_LATEST_SQL} AS ingest_ts, CAST(event_id AS BIGINT) AS seq FROM ev)
    SELECT user_id, episode_id, event, ingest_ts, seq FROM r QUALIFY row_number() OVER (PARTITION BY user_id, episode_id ORDER BY ingest_ts DESC NULLS FIRST, seq DESC) = 1"""
)
def upsert_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("event_id").cast("long")
    rows = A.events(spark, sf_dir).select("user_id", "episode_id", "event", F.when(F.col("event") != "skip", F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).alias("ingest_ts"), seq.alias("seq"))
    return merges.latest(rows, ["user_id", "episode_id"], "ingest_ts", "seq")


@query(
    """SELECT nullif(trim(c_name), '') AS name, CAST(NULL AS VARCHAR) AS missing, c_nationkey = 1 AS first_nation, c_acctbal AS balance,
    CAST(trunc(c_acctbal) AS BIGINT) AS whole, CAST(0 AS BIGINT) AS segment FROM customer"""
)
def schema_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("first_nation"), F.col("c_acctbal").alias("balance"), F.col("c_acctbal").alias("whole"), F.col("c_mktsegment").alias("segment"))
    return T.coerced(rows, {"name": "string", "missing": "string", "first_nation": "boolean", "balance": "double", "whole": "integer", "segment": "integer"})


@query(
    """WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS episode_id, quality = 0 OR toxic = 1 AS failed, CAST(1 - quality + 2 * toxic AS INTEGER) AS retry_count FROM labels),
    e AS (SELECT CAST(page_id AS VARCHAR) AS episode_id, regexp_extract(html, '<title>([^<]*)', 1) AS episode_title, CASE WHEN url LIKE '%#%' THEN '' ELSE url END AS audio_url FROM pages)
    SELECT episode_id, retry_count, episode_title, audio_url FROM t JOIN e USING (episode_id) WHERE failed AND retry_count < 3 AND audio_url <> ''"""
)
def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    # labels stand for transcripts: bad ones failed, and the two labels give the retries so far
    failed, count = (F.col("quality") == 0) | (F.col("toxic") == 1), (1 - F.col("quality") + 2 * F.col("toxic")).cast("string")
    transcripts = A.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("episode_id"), failed.alias("failed"), count.alias("retry_count"))
    url = F.when(F.contains("url", F.lit("#")), "").otherwise(F.col("url"))
    pages = A.table(spark, sf_dir, "pages").select(F.col("page_id").alias("episode_id"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("episode_title"), url.alias("audio_url"))
    return ingest.retry_queue(transcripts, pages)


@query("SELECT user_id AS key, max(event_id) AS \"offset\", arg_max(event_type, event_id) AS value FROM events GROUP BY ALL")
def log_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.compacted(A.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("offset"), F.col("event_type").alias("value")))


@query("SELECT coalesce(nullif(regexp_extract(url, '(\\d+)', 1), ''), url) AS id, page_id, url FROM pages QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_id) = 1")
def inbatch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = T.normalized_id(F.col("url"))
    return ingest.first_wins(A.table(spark, sf_dir, "pages"), key, "page_id").select(key.alias("id"), "page_id", "url")


@query("SELECT page_id, coalesce(nullif(regexp_extract(url, '(\\d+)', 1), ''), url) AS id FROM pages")
def id_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", T.normalized_id(F.col("url")).alias("id"))


@query("SELECT page_id, nullif(regexp_extract(url, '^(https?://[^/]+)', 1), '') AS host FROM pages")
def url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", T.host_prefix(F.col("url")).alias("host"))


@query("SELECT event_id AS source_id, strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%dT%H:%M:%S.000Z') AS bucket, sha1(user_id || '|' || bucket) AS event_id FROM events")
def event_id_sha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "events").withColumn("bucket", E.iso_utc(E.bucket_start(F.col("ts"), synthetic.BUCKET_MINUTES)))
    return rows.select(F.col("event_id").alias("source_id"), "bucket", E.event_id(F.col("user_id").cast("string"), F.col("bucket")).alias("event_id"))


@query(f"WITH {KNN_SQL} SELECT new_episode_id AS episode_id FROM sims UNION SELECT historical_episode_id FROM sims")
def distinct_id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.similarities(spark, sf_dir)
    return ingest.distinct_ids(found, found)


@query("SELECT doc_id, trim(coalesce(text, '')) AS transcript FROM documents WHERE length(trim(coalesce(text, ''))) > 0")
def transcript_hygiene(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = A.table(spark, sf_dir, "documents").select("doc_id", T.cleaned(F.col("text")).alias("transcript"))
    return docs.where(F.length("transcript") > 0)


@query("SELECT CAST(page_id AS VARCHAR) AS episode_id, CASE WHEN url LIKE '%?%' THEN NULL ELSE url END AS audio_url FROM pages")
def json_payload_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    # payloads of addresses with a query are broken, and of secure ones the id is only in the key
    page, url = F.col("page_id").cast("string"), F.col("url")
    payload = F.to_json(F.struct(F.when(~url.startswith("https"), page).alias("episode_id"), url.alias("audio_url")))
    messages = A.table(spark, sf_dir, "pages").select(page.alias("key"), F.when(F.contains(url, F.lit("?")), "{broken").otherwise(payload).cast("binary").alias("value"))
    return records.parsed_messages(messages).select("episode_id", "audio_url")


@query(
    """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS w FROM documents),
    s AS (SELECT doc_id, w, unnest(range(0, greatest(0, CAST(ceil((len(w) - 246) / 214.0) AS BIGINT)) + 1)) AS chunk FROM t WHERE len(w) > 0)
    SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(len(w[chunk * 214 + 1 : chunk * 214 + 246]) AS INTEGER) AS n_tokens, array_to_string(w[chunk * 214 + 1 : chunk * 214 + 246], ' ') AS chunk_text FROM s"""
)
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.chunks(A.table(spark, sf_dir, "documents"))


_CHUNKS_SQL = """t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, w, CAST(unnest(range(0, greatest(0, CAST(ceil((len(w) - 246) / 214.0) AS BIGINT)) + 1)) AS INTEGER) AS chunk FROM t WHERE len(w) > 0),
c AS (SELECT doc_id, chunk, w[chunk * 214 + 1 : chunk * 214 + 246] AS own FROM s)"""
_CRC_SQL = """crc AS (SELECT list(t ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(i))),
hashes AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS h
  FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT lower(unnest(w)) AS word FROM t)), crc)"""


@query(
    f"""WITH {_CHUNKS_SQL}, {_CRC_SQL},
    v AS (SELECT doc_id, chunk, h % 64 AS dim, sum(CASE WHEN (h >> 16) & 1 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS x FROM (SELECT doc_id, chunk, lower(unnest(own)) AS word FROM c) JOIN hashes USING (word) GROUP BY ALL),
    u AS (SELECT doc_id, dim, x / (sqrt(sum(x * x) OVER (PARTITION BY doc_id, chunk)) + 1e-8) * len(own) AS x FROM v JOIN c USING (doc_id, chunk)),
    d AS (SELECT doc_id, sum(len(own)) AS tokens, count(*) AS n_chunks FROM c GROUP BY doc_id),
    m AS (SELECT doc_id, dim, sum(x) / any_value(tokens) AS x FROM u JOIN d USING (doc_id) GROUP BY doc_id, dim),
    f AS (SELECT doc_id, map_from_entries(list((dim, x))) AS v, sqrt(sum(x * x)) + 1e-8 AS n FROM m GROUP BY doc_id)
    SELECT documents.doc_id AS doc_id, list_transform(range(64), lambda k: CAST(coalesce(f.v[k], 0.0::DOUBLE) / coalesce(f.n, 1) AS FLOAT)) AS embedding, coalesce(n_chunks, 0) AS n_chunks
    FROM documents LEFT JOIN f ON f.doc_id = documents.doc_id LEFT JOIN d ON d.doc_id = documents.doc_id"""
)
def hashing_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedded_documents(A.table(spark, sf_dir, "documents"))


@query(f"WITH {EVENTS_SQL} SELECT user_id, max(CAST(event_id AS BIGINT)) AS \"offset\" FROM ev GROUP BY ALL")
def highest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.highest_offsets(A.events(spark, sf_dir).withColumn("offset", F.col("event_id").cast("long")), "user_id")


@query(
    """WITH r AS (SELECT event_id AS "offset", CAST(event_id % 6 AS INTEGER) AS "partition", event_type AS value FROM events), e AS (SELECT "partition", max("offset") - 20 AS floor_at FROM r GROUP BY ALL)
    SELECT "partition", "offset", value FROM r JOIN e USING ("partition") WHERE "offset" > floor_at ORDER BY "partition", "offset" LIMIT 20"""
)
def tail_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = A.table(spark, sf_dir, "events").select((F.col("event_id") % 6).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("event_type").alias("value"))
    return ingest.tail(log)


@query(
    """WITH r AS (SELECT page_id AS "offset", CAST(page_id AS VARCHAR) AS episode_id, page_id // 5 AS attempt, page_id >= 12 AS is_new FROM pages)
    SELECT "offset", episode_id, CAST(attempt AS INTEGER) AS attempt, is_new FROM r WHERE attempt < 3 AND attempt <= (SELECT min(attempt) FROM r WHERE is_new AND attempt < 3)"""
)
def poll_until_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = A.table(spark, sf_dir, "pages").select(F.col("page_id").alias("offset"), F.col("page_id").cast("string").alias("episode_id"))
    return ingest.poll_until_new(log, spark.range(12).select(F.col("id").cast("string").alias("episode_id")), 5)


@query("SELECT doc_id, coalesce(lower(trim(lang)) = 'en', FALSE) AS english FROM documents")
def language_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.feeds import english

    return A.table(spark, sf_dir, "documents").select("doc_id", english(F.col("lang"), F.col("text")).alias("english"))


_FEEDS_SQL = """f AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS feed_id, nullif(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1), '') AS feed_language,
    regexp_extract(html, '<title>([^<]*)', 1) AS title, CASE WHEN page_id % 5 = 0 THEN NULL ELSE url END AS audio_url, page_id % 7 = 0 AS broken FROM pages)"""


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as responses of feeds, one a line of several files, some of them cut short; read back by the data source."""
    url = F.col("url")
    item = F.struct(F.col("page_id").alias("id"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"), F.when(F.col("page_id") % 5 != 0, url).alias("enclosureUrl"), F.col("page_id").alias("datePublished"))
    language = F.nullif(F.regexp_extract(url, r"^https?://[^/]+/([a-z]+)/", 1), F.lit(""))
    response = F.to_json(F.struct(F.regexp_extract(url, "^https?://([^/]+)", 1).alias("id"), language.alias("language"), F.array(item).alias("items")))
    whole = F.when(F.col("page_id") % 7 == 0, F.left(response, F.lit(20))).otherwise(response)
    at = f"{shared_folder(spark)}/feeds-{uuid.uuid4().hex}"
    A.table(spark, sf_dir, "pages").repartition(6, "page_id").select(whole.alias("value")).write.text(at)
    return feed_source.feeds(spark, at)


@query(f"WITH {_FEEDS_SQL} SELECT CASE WHEN broken THEN NULL ELSE feed_id END AS feed_id, CASE WHEN broken THEN NULL ELSE CAST(page_id AS VARCHAR) END AS episode_id, CASE WHEN broken THEN NULL ELSE audio_url END AS audio_url, broken FROM f")
def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed_rows(spark, sf_dir).select("feed_id", "episode_id", "audio_url", F.col("error").isNotNull().alias("broken"))


@query(
    f"""WITH {_FEEDS_SQL}, chosen AS (SELECT DISTINCT feed_id FROM f WHERE NOT broken ORDER BY feed_id LIMIT 50)
    SELECT feed_id, CAST(page_id AS VARCHAR) AS episode_id, title, audio_url FROM (SELECT * FROM f JOIN chosen USING (feed_id) WHERE NOT broken AND feed_language = 'en'
      QUALIFY row_number() OVER (PARTITION BY feed_id ORDER BY page_id DESC) = 1) WHERE audio_url <> ''"""
)
def feed_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _feed_rows(spark, sf_dir).where("error is null").drop("feed_rank")
    return feeds.newest_episodes(found).select("feed_id", "episode_id", "title", "audio_url")


_GRAMS_SQL = """g AS (SELECT doc_id, lang, '_' || unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}]+'), lambda w: w <> '')) || '_' AS w FROM documents),
    grams AS (SELECT doc_id, lang, w[i : i + 2] AS gram FROM (SELECT doc_id, lang, w, unnest(range(1, length(w) - 1)) AS i FROM g)),
    own AS (SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, gram) AS rank FROM grams GROUP BY doc_id, gram QUALIFY rank <= 300),
    learned AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS rank FROM grams WHERE doc_id % 2 = 0 AND lang IS NOT NULL GROUP BY lang, gram QUALIFY rank <= 300),
    saved AS (SELECT doc_id, lang, sum(300 - least(abs(own.rank - learned.rank), 300)) AS saved FROM own JOIN learned USING (gram) GROUP BY doc_id, lang),
    best AS (SELECT doc_id, lang AS language, 300 - saved / (SELECT count(*) FROM own WHERE own.doc_id = saved.doc_id) AS cost FROM saved QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY saved DESC, lang) = 1)"""


@query(f"WITH {_GRAMS_SQL} SELECT d.doc_id AS doc_id, language, round(cost, 6) AS cost FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN best ON best.doc_id = d.doc_id")
def language_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by its trigrams, learned from every other one."""
    docs = A.table(spark, sf_dir, "documents")
    learned = checkpointed(languages.profiles(docs.where("doc_id % 2 = 0")), "profiles")
    return languages.detected(docs, learned, "doc_id").withColumn("cost", F.round("cost", 6))


@query("SELECT page_id, url, length(html) AS n FROM pages")
def json_array_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as JSON arrays, one a task, with other items between them, read back by ranges of bytes."""
    at = f"{shared_folder(spark)}/arrays-{uuid.uuid4().hex}"
    item = F.concat(F.to_json(F.struct("page_id", "url", "html")), F.lit(', ["[{", 1], "}\\""'))
    json_arrays.as_arrays(A.table(spark, sf_dir, "pages").select(item.alias("value"))).write.text(at)
    items = json_arrays.array_objects(listed(spark, at)).select(F.from_json("item", "page_id long, url string, html string").alias("r"))
    return items.select("r.page_id", "r.url", F.length("r.html").cast("long").alias("n"))


@query(
    """SELECT CAST(page_id AS VARCHAR) AS path, CASE WHEN page_id % 7 <> 0 THEN 'wav' END AS format, CASE WHEN page_id % 7 <> 0 THEN CAST(8000 * (1 + page_id % 3) AS INTEGER) END AS rate,
    CASE WHEN page_id % 7 <> 0 THEN CAST(length(url) AS DOUBLE) END AS duration, page_id % 7 = 0 AS broken FROM pages"""
)
def audio_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heads of WAVE files as many seconds long as a page's address has letters; of every seventh the last byte is missing."""
    four = lambda x: F.lpad(F.hex(x), 8, "0")
    little = lambda x: F.concat(*(F.substring(four(x), k, 2) for k in (7, 5, 3, 1)))
    rate, seconds = 8000 * (1 + F.col("page_id") % 3), F.length("url").cast("long")
    size = rate * 2 * seconds
    text = lambda x: F.lit(x.encode().hex())
    head = F.unhex(F.concat(text("RIFF"), little(size + 36), text("WAVEfmt "), little(F.lit(16)), F.lit("01000100"), little(rate), little(rate * 2), F.lit("02001000"), text("data"), little(size)))
    heads = A.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), head.alias("head"), (size + 44 - F.when(F.col("page_id") % 7 == 0, 1).otherwise(0)).alias("length"))
    return audio.probed(heads).select("path", "format", "rate", "duration", F.col("error").isNotNull().alias("broken"))


@query("SELECT conv_id, turn, CASE WHEN role = 'user' THEN least(turn + 1, 3) ELSE turn END AS retry_count FROM conversations")
def retry_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "conversations").select("conv_id", "turn", ingest.next_retry_count(F.col("role") == "user", F.col("turn")).alias("retry_count"))


@query("SELECT conv_id, turn, coalesce(nullif(CASE WHEN role = 'user' THEN '' ELSE role END, ''), 'asked') AS filled FROM conversations")
def field_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("role") == "user", "").otherwise(F.col("role"))
    return A.table(spark, sf_dir, "conversations").select("conv_id", "turn", T.first_filled(role, F.lit("asked")).alias("filled"))


@query("SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return A.table(spark, sf_dir, "events").select("event_id", E.parsed_timestamp(text).cast("timestamp_ntz").alias("ts"))


@query("SELECT page_id, url FROM pages WHERE coalesce(url, '') <> ''")
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("episode_id"), F.col("url").alias("audio_url"))
    return records.valid_records(pages).select(F.col("episode_id").cast("long").alias("page_id"), F.col("audio_url").alias("url"))


@query("SELECT doc_id, toxic = 1 AS failed FROM labels WHERE toxic = 1")
def failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.failed(A.table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("failed")))


@query("SELECT 'events' AS name, count(*) AS n FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [A.table(spark, sf_dir, x).agg(F.count(F.lit(1)).alias("n")).select(F.lit(x).alias("name"), "n") for x in ("events", "documents", "embeddings")]
    return counts[0].union(counts[1]).union(counts[2])


def _draw_sql(salt: str, n: int, key: str) -> str:
    return f"CAST('0x' || substring(md5(concat_ws('|', 1, '{salt}', {key})), 1, 8) AS BIGINT) % {n}"


def _pick_sql(values: tuple[str, ...], salt: str, key: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][1 + {_draw_sql(salt, len(values), key)}]"


PEOPLE, EPISODES, NOW = 500, 100, "2024-01-31 12:34:56"
_PEOPLE_SQL = f"""people AS (
    SELECT substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-' || substring(h, 13, 4) || '-' || substring(h, 17, 4) || '-' || substring(h, 21, 12) AS id,
      {_pick_sql(synthetic.NAMES, 'name', 'n')} AS name, {_pick_sql(synthetic.SURNAMES, 'surname', 'n')} AS surname,
      strftime(DATE '{synthetic.FIRST_BIRTH}' + CAST(CAST('0x' || substring(md5(concat_ws('|', 1, 'born', n)), 1, 8) AS BIGINT)
        % (DATE '{synthetic.LAST_BIRTH}' - DATE '{synthetic.FIRST_BIRTH}' + 1) AS INTEGER), '%Y-%m-%d') AS date_of_birth,
      {_pick_sql(synthetic.GENDERS, 'gender', 'n')} AS gender
    FROM (SELECT range AS n, md5(concat_ws('|', 1, range)) AS h FROM range({PEOPLE})))"""


@query(f"WITH {_PEOPLE_SQL} SELECT * FROM people")
def synthetic_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.users(spark, PEOPLE)


@query(
    f"""WITH {_PEOPLE_SQL}, chosen AS (SELECT id AS user_id FROM people
      QUALIFY row_number() OVER (ORDER BY md5(concat_ws('|', 1, id)), id) <= {synthetic.LEAST_USERS} + {_draw_sql('size', PEOPLE - synthetic.LEAST_USERS + 1, str(PEOPLE))}),
    drawn AS (SELECT user_id, '2024-01-31T12:30:00.000Z' AS bucket, {_pick_sql(synthetic.EVENTS, 'event', 'user_id')} AS event,
      CAST({_draw_sql('at', synthetic.MOST_SECONDS + 1, 'user_id')} AS INTEGER) AS a, CAST({_draw_sql('to', synthetic.MOST_SECONDS + 1, 'user_id')} AS INTEGER) AS b FROM chosen)
    SELECT sha1(user_id || '|' || bucket) AS event_id, user_id, CAST({_draw_sql('episode', EPISODES, 'user_id')} AS VARCHAR) AS episode_id, event,
      {_pick_sql(synthetic.DEVICES, 'device', 'user_id')} AS device, '2024-01-31T12:34:56.000Z' AS ts, bucket,
      CASE WHEN event = 'rate' THEN CAST(1 + {_draw_sql('rating', 5, 'user_id')} AS INTEGER) END AS rating, CASE WHEN event = 'pause' THEN a END AS position_sec,
      CASE WHEN event = 'skip' THEN least(a, b) END AS from_sec, CASE WHEN event = 'skip' THEN greatest(a, b) END AS to_sec,
      CASE WHEN event = 'complete' THEN 1.0::DOUBLE END AS played_pct FROM drawn"""
)
def synthetic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.events(synthetic.users(spark, PEOPLE), [str(k) for k in range(EPISODES)], NOW)


@query("SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS episode_id FROM part ORDER BY md5(concat_ws('|', 1, episode_id)), episode_id LIMIT 500")
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.sample(A.episodes(spark, sf_dir).select("episode_id").distinct(), 500, "episode_id")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "events").select((F.col("event_id") % 6).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("user_id").cast("string").alias("episode_id"), "event_type")


@query('SELECT CAST(event_id % 6 AS INTEGER) AS "partition", max(event_id) AS "offset" FROM events GROUP BY ALL')
def partition_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.highest_offsets(_log(spark, sf_dir), "partition")


@query(
    """WITH r AS (SELECT event_id AS "offset", CAST(event_id % 6 AS INTEGER) AS "partition", event_type FROM events), e AS (SELECT "partition", max("offset") AS done FROM r WHERE event_type = 'signup' AND "offset" < 5000 GROUP BY ALL)
    SELECT "partition", "offset", event_type FROM r LEFT JOIN e USING ("partition") WHERE done IS NULL OR "offset" > done"""
)
def resumed_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a first poll ended at offset 5,000 and was done with its signups; the next one reads on from there
    log, offsets = _log(spark, sf_dir), Offsets(spark, f"{shared_folder(spark)}/offsets-{uuid.uuid4().hex}")
    polled = log.where("offset < 5000")
    offsets.commit(polled.where("event_type = 'signup'"))
    offsets.commit(polled.where("event_type = 'signup' and offset < 100"))
    return offsets.unread(log).select("partition", "offset", "event_type")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of two models, on days by their labels."""
    model = F.when(F.col("label") < 4, "old").otherwise("new")
    return A.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("episode_id"), "embedding", model.alias("model"), F.format_string("2024-01-%02d", F.col("label").cast("int") % 28 + 1).alias("date"))


_VERSIONS_SQL = """v AS (SELECT CAST(vec_id AS VARCHAR) AS episode_id, embedding, CASE WHEN label < 4 THEN 'old' ELSE 'new' END AS model, printf('2024-01-%02d', CAST(label AS INTEGER) % 28 + 1) AS date FROM embeddings)"""


@query(f"WITH {_VERSIONS_SQL} SELECT episode_id, len(embedding) AS n FROM v WHERE model = 'new' AND date < '2024-01-08'")
def earlier_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.earlier(_versions(spark, sf_dir), "new", "2024-01-08").select("episode_id", F.size("embedding").cast("long").alias("n"))


@query(
    f"""WITH {_VERSIONS_SQL}, t AS (SELECT CAST(doc_id AS VARCHAR) AS episode_id, trim(coalesce(text, '')) AS transcript FROM documents)
    SELECT episode_id, transcript FROM t WHERE transcript <> '' AND episode_id NOT IN (SELECT episode_id FROM v WHERE model = 'new') ORDER BY episode_id LIMIT {ingest.EMBED_LIMIT}"""
)
def pending_of_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    transcripts = A.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"), F.col("text").alias("transcript"))
    return ingest.pending(transcripts, ingest.embedded_by(_versions(spark, sf_dir), "new"), most=ingest.EMBED_LIMIT)


@query(f"WITH {EVENTS_SQL}, {HISTORY_SQL} SELECT user_id, episode_id AS historical_episode_id FROM history")
def history_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = A.history(spark, sf_dir)
    return documents.history(once.unionByName(once))


@query(f"WITH {KNN_SQL} SELECT new_episode_id AS episode_id, historical_episode_id AS similar_episode_id, similarity FROM sims")
def neighbour_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.similarities(spark, sf_dir).withColumn("similarity", F.col("similarity").cast("string"))
    broken = found.limit(1).withColumn("similarity", F.lit("none"))
    return documents.neighbours(found.unionByName(broken))


@query("SELECT trim(c_name) AS name, CAST(trunc(c_acctbal) AS BIGINT) AS whole, CAST(NULL AS VARCHAR) AS missing FROM customer")
def overwrite_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = {"name": "string", "whole": "integer", "missing": "string"}
    table = Table(spark, f"{shared_folder(spark)}/coerced-{uuid.uuid4().hex}", T.struct_of(form))
    sinks.overwrite_coerced(A.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("whole")), table, form)
    return table.read()
