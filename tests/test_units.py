"""Semantics of single operators on small frames."""

import datetime
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import events as E
from tidemark.functions import text as T
from tidemark.operators import dashboard, embedding, engagement, ingest, knn, merges, recommend
from tidemark.sources import documents, feeds, records, sinks, synthetic
from tidemark.sources.offsets import Offsets
from tidemark.sources.tables import Table, tolerant_read


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def at(text):
    return datetime.datetime.fromisoformat(text)


def test_engagement_weights(spark):
    df = spark.createDataFrame(
        [("like", None, None, 3.0), ("complete", None, None, 2.0), ("rate", 5, None, 2.0), ("rate", 2, None, 0.0), ("rate", None, None, 0.0), ("pause", None, 300, 0.5), ("pause", None, 9000, 1.0), ("pause", None, None, 0.0), ("skip", None, None, 0.0), ("other", None, None, 0.0), (None, None, None, 0.0)],
        "event string, rating int, position_sec int, wanted double",
    )
    assert df.where(E.engagement() != F.col("wanted")).count() == 0


def test_dashboard_weights_may_be_negative(spark):
    df = spark.createDataFrame([("skip",), ("like",), ("none",), (None,)], "event string")
    assert rows(df.select(E.dashboard_weight())) == [(-1.0,), (0.0,), (0.0,), (2.0,)]


def test_times_are_cut_to_milliseconds(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.123456+00:00",), ("2024-01-01T02:00:00.123+02:00",), ("2024-01-01",), ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(E.parsed_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-01 00:00:00.123", "2024-01-01 00:00:00.123", None, None, None]


def test_coercion(spark):
    df = spark.createDataFrame([(" a ", "yes", "1.5", "7", "x"), ("  ", "no", "bad", "bad", "x"), (None, None, None, None, "x"), ("b", "True", "", "3.0", "x")], "s string, b string, d string, i string, extra string")
    got = T.coerced(df, {"i": "integer", "s": "string", "b": "boolean", "d": "double", "new": "string"})
    assert got.columns == ["i", "s", "b", "d", "new"]
    assert [tuple(r) for r in got.collect()] == [(7, " a ", True, 1.5, None), (0, None, False, None, None), (0, None, False, None, None), (3, "b", True, None, None)]


def test_ids_hosts_and_fallbacks(spark):
    df = spark.createDataFrame([("ep-123-4", "https://h.org/x"), ("none", "ftp://h.org"), (None, "")], "a string, b string")
    got = df.select(T.normalized_id(F.col("a")), T.host_prefix(F.col("b")), T.first_filled(F.col("b"), F.lit("z")))
    assert [tuple(r) for r in got.collect()] == [("123", "https://h.org", "https://h.org/x"), ("none", None, "ftp://h.org"), (None, None, "z")]


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="b, c"):
        T.require(spark.range(1).toDF("a"), "a", "b", "c")


DAILY = "user_id string, episode_id string, day date, engagement double, num_events long, last_ts timestamp"


def test_additive_merge_over_any_split(spark):
    day = datetime.date(2024, 1, 1)
    parts = [[("u", "e", day, 1.0, 1, at("2024-01-01T05:00:00"))], [("u", "e", day, 2.0, 3, at("2024-01-01T04:00:00")), ("v", "e", day, 0.0, 1, at("2024-01-01T06:00:00"))], [("u", "e", day, 0.5, 1, at("2024-01-01T07:00:00"))]]
    merge = merges.additive(["user_id", "episode_id", "day"], F.lit("2024-01-02").cast("timestamp"))
    empty = spark.createDataFrame([], schemas.DAILY_ENGAGEMENT)
    one = merge(empty, spark.createDataFrame([x for p in parts for x in p], DAILY).groupBy("user_id", "episode_id", "day").agg(F.sum("engagement").alias("engagement"), F.sum("num_events").alias("num_events"), F.max("last_ts").alias("last_ts")))
    many = empty
    for p in parts:
        many = merge(many, spark.createDataFrame(p, DAILY))
    assert rows(one) == rows(many) and len(rows(one)) == 2


def test_set_on_insert_can_move_back(spark):
    target = spark.createDataFrame([("u", "e", at("2024-01-01T00:00:00"), at("2024-01-05T00:00:00"))], schemas.USER_HISTORY)
    source = spark.createDataFrame([("u", "e", at("2024-01-03T00:00:00")), ("u", "f", at("2024-01-04T00:00:00"))], "user_id string, episode_id string, last_ts timestamp")
    for monotone, last in ((False, 3), (True, 5)):
        got = {r["episode_id"]: r for r in merges.set_on_insert(["user_id", "episode_id"], monotone)(target, source).collect()}
        assert got["e"]["first_seen_at"].day == 1 and got["e"]["last_seen_at"].day == last and got["f"]["first_seen_at"].day == 4


def test_a_null_time_wins(spark):
    target = spark.createDataFrame([("a", "old", "2024-01-02"), ("b", "old", None), ("c", "old", "2024-01-01")], "k string, v string, ingest_ts string")
    source = spark.createDataFrame([("a", "new", "2024-01-01"), ("b", "new", "2024-01-03"), ("c", "new", "2024-01-01")], target.schema)
    assert rows(merges.keep_latest(["k"])(target, source), "k", "v") == [("a", "old"), ("b", "old"), ("c", "new")]


def test_episode_and_transcript_upserts(spark):
    now = F.lit("2024-02-01").cast("timestamp")
    target = spark.createDataFrame([("1", "a", at("2024-01-01T00:00:00"), at("2024-01-01T00:00:00"))], "episode_id string, transcript string, created_at timestamp, updated_at timestamp")
    source = spark.createDataFrame([("1", "b"), ("2", "c")], "episode_id string, transcript string")
    got = {r["episode_id"]: r for r in merges.upsert_episodes(now)(target, source).collect()}
    assert got["1"]["transcript"] == "b" and got["1"]["created_at"].month == 2
    assert rows(merges.upsert_transcripts(True, now)(target, source), "episode_id", "transcript") == [("1", "a"), ("2", "c")]
    updated = {r["episode_id"]: r for r in merges.upsert_transcripts(False, now)(target, source).collect()}
    assert (updated["1"]["transcript"], updated["1"]["created_at"].month, updated["1"]["updated_at"].month) == ("b", 1, 2)


def test_table_layer(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", schemas.DAILY_ENGAGEMENT, "day")
    assert not t.exists() and t.read().count() == 0
    t.ensure()
    assert t.exists() and t.read().count() == 0
    source = lambda day, n: spark.createDataFrame([("u", "e", day, float(n), n, at("2024-01-01T00:00:00"))], DAILY)
    merge = merges.additive(["user_id", "episode_id", "day"])
    first, second = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    assert t.merge(source(first, 1), merge, "w", 0) and t.merge(source(second, 5), merge, "w", 1)
    untouched = t.state()["parts"]["2024-01-02"]
    assert not t.merge(source(first, 1), merge, "w", 1)  # a replayed batch
    assert t.merge(source(first, 2), merge, "w", 2) and t.state()["parts"]["2024-01-02"] == untouched
    assert rows(t.read(), "day", "num_events") == [(first, 3), (second, 5)]
    t.append(source(first, 9).withColumn("extra", F.lit("x")))
    assert t.read().count() == 3 and t.read().columns[-1] == "extra"
    t.compact()
    assert t.read().count() == 3 and all(len(x) == 1 for x in t.state()["parts"].values())
    assert t.overwrite(t.read().where("extra is null").drop("extra")) == 2
    assert rows(t.existing_ids("user_id")) == [("u",)]


def test_tolerant_read(spark, tmp_path):
    assert tolerant_read(spark, f"file://{tmp_path}/none", schemas.USER).count() == 0


def test_sinks(spark, tmp_path):
    df, wrote = spark.range(3), []

    def broken(_):
        raise OSError("down")

    assert sinks.first_that_works(df, [broken, lambda x: wrote.append(x.count())]) == 1 and wrote == [3]
    assert sinks.first_that_works(df, [broken]) is None
    t = Table(spark, f"file://{tmp_path}/users", schemas.USER)
    people = synthetic.users(spark, 5)
    assert sinks.load_once(people.union(people), t, "id") and t.read().count() == 5
    assert not sinks.load_once(people, t, "id")


@pytest.mark.parametrize("text", ['[{"episode_id": 1, "text": "a"}, 5, {"episode_id": "2"}]', '{"episode_id": 1,\n "text": "a"}', '{"episode_id": "1", "text": "a"}\n{"episode_id": "2"}\nbad\n'])
def test_json_records(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    got = records.json_records(spark, f"file://{tmp_path}/r.json", schemas._struct("episode_id string, text string"))
    assert [r["episode_id"] for r in got.orderBy("episode_id").collect()] in (["1"], ["1", "2"])
    episodes, transcripts = records.episodes_and_transcripts(got)
    assert transcripts.orderBy("episode_id").first()["transcript"] == "a" and episodes.columns == schemas.EPISODE.names


def test_json_without_records(spark, tmp_path):
    (tmp_path / "r.json").write_text("[1, 2]")
    with pytest.raises(ValueError, match="no valid record"):
        records.json_records(spark, f"file://{tmp_path}/r.json", schemas._struct("episode_id string, text string"))


def test_messages(spark):
    df = spark.createDataFrame([("k1", b'{"episode_id": "7", "audio_url": "u"}'), ("k2", b"{broken"), ("k3", b'{"episode_id": ""}')], "key string, value binary")
    assert rows(records.parsed_messages(df), "episode_id", "audio_url", "json_str") == [("7", "u", '{"episode_id": "7", "audio_url": "u"}'), ("k2", None, "{}"), ("k3", None, '{"episode_id": ""}')]
    assert rows(records.to_messages(spark.createDataFrame([("1", "a")], "id string, v string"), "id")) == [("1", '{"id":"1","v":"a"}')]


def test_feeds(spark):
    listed = [
        {"feed_id": "f1", "feed_language": "EN ", "episode_id": "1", "title": "t", "audio_url": "u", "published": 1},
        {"feed_id": "f1", "feed_language": "en", "episode_id": "2", "title": "t", "audio_url": "u", "published": 2},
        {"feed_id": "f2", "feed_language": "de", "episode_id": "3", "title": "hello", "audio_url": "u", "published": 2},
        {"feed_id": "f3", "feed_language": None, "episode_id": "4", "title": "raise", "audio_url": "u", "published": 2},
        {"feed_id": "f4", "feed_language": "en", "episode_id": "5", "title": "t", "audio_url": "", "published": 2},
    ]

    def detect(text):
        if "raise" in text:
            raise ValueError(text)
        return "en" if "hello" in text else "xx"

    found = feeds.fetched(spark, lambda: listed)
    assert rows(feeds.newest_episodes(found), "episode_id") == [("2",)]
    assert rows(feeds.newest_episodes(found, detect), "episode_id") == [("2",), ("3",)]
    assert feeds.auth_headers("k", "s", 1)["Authorization"] == hashlib.sha1(b"ks1").hexdigest()


def test_transcription_errors_are_rows(spark):
    def transcribe(url):
        if url == "bad":
            raise OSError("no file")
        return {"transcript": "text", "duration": 6000.0 if url == "long" else 10.0, "language": "en"}

    df = spark.createDataFrame([("1", "ok"), ("2", "bad"), ("3", "long"), ("4", None)], "episode_id string, audio_url string")
    got = {r["episode_id"]: (r["failed"], r["transcript"], r["error"]) for r in feeds.transcribed(df, transcribe).collect()}
    assert got == {"1": (False, "text", None), "2": (True, "", "OSError: no file"), "3": (True, "", "longer than 5400 seconds"), "4": (True, "", "no audio address")}


def test_synthetic_rows(spark):
    people = synthetic.users(spark, 40)
    assert people.columns == schemas.USER.names and people.select("id").distinct().count() == 40 and rows(people) == rows(synthetic.users(spark, 40))
    one = synthetic.events(people, ["1", "2"], "2024-01-01 00:12:00")
    again = synthetic.events(people, ["1", "2"], "2024-01-01 00:19:00")
    assert 30 <= one.count() <= 40 and rows(one, "event_id") == rows(again, "event_id")  # one bucket
    assert one.where("event = 'rate' and (rating is null or rating not between 1 and 5)").isEmpty()
    assert synthetic.events(synthetic.users(spark, 5), ["1"], "2024-01-01 00:00:00").count() == 5
    assert rows(synthetic.sample(spark.range(9), 4, "id")) == rows(synthetic.sample(spark.range(9), 4, "id"))


VECTOR = "id string, embedding array<double>"


def test_knn_edges(spark):
    batch = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0])], VECTOR)
    own = knn.top_k(batch, None, 3).collect()
    assert {r["new_id"] for r in own} == {"a", "b", "c"} and all(sum(r["new_id"] == x for r in own) <= 2 for x in "ab")
    assert sum(r["new_id"] == "a" for r in knn.top_k(batch, None, 3, exclude_self=True).collect()) == 3
    history = spark.createDataFrame([("h", [2.0, 0.0]), ("z", [0.0, 0.0]), ("g", [2.0, 0.0])], VECTOR)
    got = [(r["historical_id"], r["similarity"]) for r in knn.top_k(batch.where("id = 'a'"), history, 3).orderBy("rank").collect()]
    assert got == [("g", 1.0), ("h", 1.0), ("z", 0.0)]
    assert knn.top_k(batch.limit(0), history).count() == 0
    table = knn.similarities(knn.top_k(batch, history), "m")
    assert table.columns == schemas.SIMILARITY.names and table.where("abs(similarity + distance_embed - 1) > 1e-12").isEmpty()


def test_knn_forms_and_blocks_agree(spark):
    draw = np.random.default_rng(0)
    df = spark.createDataFrame([(str(i), draw.normal(size=8).tolist()) for i in range(60)], VECTOR).repartition(5)
    whole = rows(knn.top_k(df, df))
    assert whole == rows(knn.top_k(df, df, query_tile=7)) == rows(knn.top_k_by_expressions(df, df))


def test_top_n_breaks_ties_by_episode(spark):
    df = spark.createDataFrame([("u", x, 1.0) for x in "dcba"] + [("v", "a", 0.5)], "user_id string, recommended_episode_id string, score double")
    assert rows(recommend.top_n(df, 2), "user_id", "recommended_episode_id") == [("u", "a"), ("u", "b"), ("v", "a")]


def test_hybrid_is_driven_by_the_collaborative_side(spark):
    als = spark.createDataFrame([("u", "1", 0.5), ("u", "1", 0.4), ("u", "2", 1.0), (None, "3", 1.0)], "user_id string, episode_id string, als_score double")
    similar = spark.createDataFrame([("1", "9", 0.8), ("1", "8", 0.9), ("7", "9", 1.0)], "new_episode_id string, historical_episode_id string, similarity double")
    history = spark.createDataFrame([("u", "9"), ("u", "9"), ("u", "8")], "user_id string, episode_id string")
    got = {r[1]: round(r[2], 9) for r in recommend.hybrid(als, similar, history).collect()}
    assert got == {"1": round(0.7 * 0.5 + 0.3 * 0.9, 9), "2": 0.7}


def test_als(spark, tmp_path):
    with pytest.raises(ValueError, match="no ratings"):
        recommend.fit(spark.createDataFrame([], "user_id string, episode_id string, engagement double"))
    rated = spark.createDataFrame([(f"u{i}", f"e{j}", 1.0 + i % 3) for i in range(8) for j in range(6) if (i + j) % 2], "user_id string, episode_id string, engagement double")
    got = recommend.recommended(rated, 3, rank=4, iterations=2)
    assert got.count() == 24 and got.select("user_id").distinct().count() == 8
    recommend.save(*recommend.fit(rated, rank=2, iterations=1), f"file://{tmp_path}/model")


def test_frequency_index_matches_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(c,) for c in "aabbbcddddefg"] + [(None,)], "x string").repartition(5)
    wanted = StringIndexer(inputCol="x", outputCol="i", handleInvalid="skip").fit(df).labels
    rated = df.select(F.col("x").alias("user_id"), F.lit("e").alias("episode_id"), F.lit(1.0).alias("engagement"))
    assert [r["user_id"] for r in recommend.id_maps(spark, recommend.indexed(rated))["user_id"].orderBy("user_idx").collect()] == wanted


def test_ingestion(spark):
    transcripts = spark.createDataFrame([("1", True, "1"), ("2", True, "3"), ("3", False, "0"), (" ", True, "0"), (None, True, "0"), ("4", True, "bad"), ("5", True, None)], "episode_id string, failed boolean, retry_count string")
    episodes = spark.createDataFrame([("1", "t", "u"), ("2", "t", "u"), ("4", "t", ""), ("5", "t", "u")], "episode_id string, episode_title string, audio_url string")
    retries = ingest.retry_queue(transcripts, episodes)
    assert rows(retries, "episode_id", "retry_count") == [("1", 1), ("5", 0)]
    new = spark.createDataFrame([("5", "new"), ("6", "new")], "episode_id string, audio_url string")
    assert rows(ingest.worklist(retries, new), "episode_id", "audio_url") == [("1", "u"), ("5", "u"), ("6", "new")]
    counts = spark.createDataFrame([(True, 1), (True, 3), (False, 2)], "f boolean, n int")
    assert [r[0] for r in counts.select(ingest.next_retry_count(F.col("f"), F.col("n"))).collect()] == [2, 3, 2]
    assert rows(ingest.unseen(new, new.limit(0)), "episode_id") == [("5",), ("6",)] == rows(ingest.unseen(new, None), "episode_id")


def test_known_ids_are_normalised_keys(spark):
    df = spark.createDataFrame([(b"ep-12",), (b"12",), (b"x",), (None,)], "key binary")
    assert rows(ingest.known_ids(df)) == [("12",), ("x",)]


def test_poll_stops_at_the_first_new_batch(spark):
    log = spark.createDataFrame([(i, f"e{i}") for i in range(20)], "offset long, episode_id string")
    poll = lambda known: ingest.poll_until_new(log, spark.createDataFrame([(f"e{i}",) for i in range(known)], "episode_id string"), 4)
    assert poll(6).agg(F.max("offset")).first()[0] == 7 and poll(6).where("is_new").count() == 2
    assert poll(20).count() == 12 and poll(20).where("is_new").isEmpty()
    assert ingest.poll_until_new(log.limit(0), log, 4).count() == 0


def test_pending_needs_its_columns(spark):
    with pytest.raises(ValueError, match="transcript"):
        ingest.pending(spark.createDataFrame([("1",)], "episode_id string"), spark.createDataFrame([], "episode_id string"))
    df = spark.createDataFrame([("1", " a ", "d1"), ("2", " ", "d1"), ("3", "c", "d2"), ("4", None, "d1")], "episode_id string, transcript string, date string")
    done = spark.createDataFrame([("3",)], "episode_id string")
    assert rows(ingest.pending(df, done), "episode_id", "transcript") == [("1", "a")] and ingest.pending(df, done, "d2").count() == 0


def test_trailing_window(spark):
    df = spark.createDataFrame([("1", at("2024-01-01T00:00:00")), ("2", at("2024-01-01T00:31:00")), ("3", at("2024-01-01T00:01:00")), ("4", None)], "event_id string, ts timestamp")
    assert [r["event_id"] for r in dashboard.trailing(df, 30).collect()] == ["3", "2"]
    assert dashboard.trailing(df.where("ts is null"), 30).count() == 0


def test_bayesian_rating(spark):
    df = spark.createDataFrame([("a", "rate", 5)] * 10 + [("b", "rate", 5)] + [("c", "rate", 1)] * 9 + [("a", "like", None), ("d", "rate", None)], "episode_title string, event string, rating int")
    got = [(r["episode_title"], r["votes"]) for r in dashboard.top_rated(df).collect()]
    assert got == [("a", 10), ("b", 1), ("c", 9)]


def test_window_sizes():
    assert embedding.window_of() == (246, 214) and embedding.window_of(tokens=10) == (8, 1)


@pytest.mark.parametrize("n,wanted", [(0, []), (1, [1]), (246, [246]), (247, [246, 33]), (460, [246, 246]), (461, [246, 246, 33])])
def test_chunks_stop_at_the_end(spark, n, wanted):
    df = spark.createDataFrame([(1, " ".join(["w"] * n))], "doc_id long, text string")
    assert [r["n_tokens"] for r in embedding.chunks(df).orderBy("chunk").collect()] == wanted


def test_document_vectors(spark):
    df = spark.createDataFrame([(1, "a b c " * 300), (2, "a"), (3, ""), (4, None)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: np.array(r["embedding"]) for r in embedding.embedded_documents(df).collect()}
    assert not got[3].any() and not got[4].any() and np.linalg.norm(got[1]) == pytest.approx(1, abs=1e-5)
    parts = [r for r in embedding.chunks(df.where("doc_id = 1")).orderBy("chunk").collect()]
    weights = np.array([r["n_tokens"] for r in parts])
    mean = (embedding.hashing_encoder([r["chunk_text"] for r in parts]) * (weights / weights.sum())[:, None]).sum(axis=0)
    assert np.allclose(got[1], mean / np.linalg.norm(mean), atol=1e-5)


def test_engagement_counts_weightless_events(spark):
    df = spark.createDataFrame([("u", "e", k, None, None, at("2024-01-01T00:00:00")) for k in ("skip", "like", "odd")], "user_id string, episode_id string, event string, rating int, position_sec int, ts timestamp")
    row = engagement.daily(df).first()
    assert (row["engagement"], row["num_events"]) == (3.0, 3)


def test_knn_tiles_agree(spark):
    from tidemark.operators import knn

    df = spark.range(60).selectExpr("cast(id as string) id", "array(cast(id % 7 as float), cast(id % 5 - 2 as float), cast(1 as float)) embedding")
    one, many = (sorted(map(tuple, knn.top_k(df, df, 4, query_tile=a, history_tile=b).collect())) for a, b in ((100, 100), (7, 11)))
    assert one == many


def test_json_files_of_each_kind_in_one_folder(spark, tmp_path):
    from tidemark import schemas
    from tidemark.sources import records

    (tmp_path / "a.json").write_text('[{"id": "1"}, 7,\n {"id": "2"}]')
    (tmp_path / "b.json").write_text('{"id": "3"}\n\n{"id": "4"}\n')
    (tmp_path / "c.json").write_text('{\n "id": "5"\n}')
    (tmp_path / "d.json").write_text('{"other": 1}\nnot json\n{"id": "6"}')
    got = records.json_records(spark, f"file://{tmp_path}", schemas._struct("id string"))
    assert sorted((r["id"] or "") for r in got.collect()) == ["", "1", "2", "3", "4", "5", "6"]


def test_tables_refuse_stale_writers_and_delete_old_folders(spark, tmp_path):
    import pytest

    from tidemark import schemas
    from tidemark.sources.tables import Table, tolerant_read

    t = Table(spark, f"file://{tmp_path}/t", schemas._struct("user_id string, n string"), "user_id", buckets=4)
    t.append(spark.createDataFrame([(str(i), "a") for i in range(20)], "user_id string, n string"))
    stale = t.state()
    seen = []
    t.merge(spark.createDataFrame([("3", "b")], "user_id string, n string"), lambda old, new: seen.append(old.count()) or old.join(new, "user_id", "left_anti").unionByName(new))
    assert 0 < seen[0] < 20 and t.read().count() == 20 and t.read().where("n = 'b'").count() == 1
    with pytest.raises(RuntimeError):
        t._set(stale)
    t.overwrite(t.read())
    assert t.vacuum() == 2 and t.read().count() == 20
    (tmp_path / "bad.parquet").write_text("no parquet")
    assert tolerant_read(spark, f"file://{tmp_path}/bad.parquet", t.schema).count() == 0


def test_offsets_go_on_where_the_last_poll_ended(spark, tmp_path):
    log = spark.createDataFrame([(p, o, f"e{p}{o}") for p in range(3) for o in range(4)], "partition int, offset long, episode_id string")
    offsets = Offsets(spark, f"file://{tmp_path}/offsets")
    assert offsets.unread(log).count() == 12
    offsets.commit(log.limit(0))
    assert offsets.unread(log).count() == 12
    offsets.commit(log.where("partition = 0 and offset <= 1"))
    offsets.commit_ids(log, spark.createDataFrame([("e12",), ("none",), (None,)], "episode_id string"))
    assert rows(offsets.unread(log), "partition", "offset") == [(0, 2), (0, 3), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)]
    offsets.commit(log.where("offset = 0"))  # an old commit, sent again, moves partition 2 only
    assert rows(offsets.unread(log).groupBy("partition").agg(F.min("offset"))) == [(0, 2), (1, 3), (2, 1)]


def test_a_commit_is_tried_again(spark, tmp_path, monkeypatch):
    offsets, merge, calls = Offsets(spark, f"file://{tmp_path}/offsets"), Table.merge, []

    def flaky(self, *args):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("has changed")
        return merge(self, *args)

    monkeypatch.setattr(Table, "merge", flaky)
    log = spark.createDataFrame([(0, 5)], "partition int, offset long")
    offsets.commit(log, backoff=0)
    assert len(calls) == 3 and rows(offsets.table.read()) == [(0, 6)]
    calls.clear()
    with pytest.raises(RuntimeError):
        offsets.commit(log, retries=1, backoff=0)


def test_documents_as_frames(spark):
    df = spark.createDataFrame([("u", "1", "0.5", "x"), ("u", "1", "0.5", "y"), (None, "1", "1", "z"), ("u", "2", "bad", "z")], "user_id string, episode_id string, als_score string, extra string")
    assert rows(documents.history(df)) == [("u", "1"), ("u", "2")]
    assert rows(documents.scores(df)) == [("u", "1", 0.5), ("u", "1", 0.5)]
    assert documents.neighbours(df).columns == list(documents.NEIGHBOURS) and documents.neighbours(df).count() == 0
    assert rows(documents.found(df, "extra", "missing").limit(1)) == [("x", None)]


def test_overwrite_coerces(spark, tmp_path):
    form = {"name": "string", "n": "integer", "ok": "boolean"}
    table = Table(spark, f"file://{tmp_path}/t", T.struct_of(form))
    df = spark.createDataFrame([(" ", "3.0", 1), ("a", "x", 2)], "name string, n string, extra int")
    assert sinks.overwrite_coerced(df, table, form) == 2
    assert rows(table.read()) == [("a", 0, False), (None, 3, False)]


# a lambda, so that it travels by value: workers can't import this module
_letters = lambda: (lambda text: [ord(c) for c in text], lambda ids: "".join(map(chr, ids)))


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 10, 30])
def test_token_windows_stop_at_the_end(spark, n):
    text = "".join(chr(97 + i % 26) for i in range(n))
    df = spark.createDataFrame([(1, text), (2, None), (3, "  ")], "doc_id long, text string")
    got = [(r["doc_id"], r["chunk"], r["n_tokens"], r["chunk_text"]) for r in embedding.token_chunks(df, _letters, tokens=18, overlap=3).orderBy("chunk").collect()]
    wanted, start = [], 0
    while n:
        wanted.append((1, len(wanted), len(text[start : start + 8]), text[start : start + 8]))
        if start + 8 >= n:
            break
        start += 5
    assert got == wanted


def test_blank_token_windows_are_skipped(spark):
    df = spark.createDataFrame([("a", "x" * 8 + " " * 12 + "y")], "doc_id string, text string")
    got = embedding.token_chunks(df, _letters, tokens=18, overlap=0).orderBy("chunk").collect()
    assert [(r["chunk"], r["chunk_text"]) for r in got] == [(0, "xxxxxxxx"), (1, "y")]


def test_windows_of_a_tokenizer_file(spark):
    path = "/opt/tokenizers/byte_bpe_50k.json"
    tokenizers = pytest.importorskip("tokenizers")
    own, text = tokenizers.Tokenizer.from_file(path), "Long texts are cut into windows of tokens. " * 40
    ids = own.encode(text.strip(), add_special_tokens=False).ids
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [(r["n_tokens"], r["chunk_text"]) for r in embedding.token_chunks(df, embedding.file_codec(path)).orderBy("chunk").collect()]
    starts = [0, *range(214, max(1, len(ids) - 246 + 214), 214)]
    assert got == [(len(ids[s : s + 246]), own.decode(ids[s : s + 246]).strip()) for s in starts]


def test_vectors_carry_their_model(spark):
    df = spark.createDataFrame([("1", "a b c", "2024-01-01"), ("2", None, "2024-01-02"), ("3", "d", "2024-01-03"), ("3", "d", "2024-01-03")], "episode_id string, transcript string, date string")
    got = embedding.embedded_transcripts(df, embedding.EncoderSettings(model="m", batch=1))
    assert got.columns == ["episode_id", "date", "embedding", "model", "created_at"] and got.count() == 3
    assert rows(ingest.embedded_by(got, "m")) == [("1",), ("2",), ("3",)] and ingest.embedded_by(got, "other").count() == 0
    assert rows(ingest.earlier(got, "m", "2024-01-02"), "episode_id") == [("1",)] and ingest.earlier(got, "m").count() == 3
    by_letters = {r["episode_id"]: r["embedding"] for r in embedding.embedded_transcripts(df, make=_letters).collect()}
    assert not any(by_letters["2"]) and any(by_letters["3"])
    waiting = ingest.pending(df.drop("date"), got.where("episode_id = '1'"), most=1)
    assert rows(waiting, "episode_id") == [("3",)]


def test_recommendations_are_those_of_the_factors(spark, small):
    """als_recs' scores and ranks, by numpy from the saved model's factors."""
    from pyspark.ml.recommendation import ALSModel

    from tidemark.plans import adapters as A
    from tidemark.sources.tables import checkpointed, shared_folder

    rated = checkpointed(recommend.ratings(A.daily(spark, small)), "ratings")
    indexers, model = recommend.fit(rated, rank=8, iterations=3)
    at = f"{shared_folder(spark)}/model-of-a-test"
    recommend.save(indexers, model, at)
    saved = ALSModel.load(f"{at}/als")
    factors = [{r["id"]: np.array(r["features"], np.float32) for r in x.collect()} for x in (saved.userFactors, saved.itemFactors)]
    names = [{r[0]: r[1] for r in df.select(i, c).collect()} for (c, i), df in zip(recommend.INDICES.items(), recommend.id_maps(spark, indexers).values(), strict=True)]
    assert len(names[0]) == len(factors[0]) and len(names[1]) == len(factors[1])
    items = sorted(factors[1])
    scores = {names[0][u]: dict(zip((names[1][i] for i in items), np.array([factors[1][i] for i in items]) @ x, strict=True)) for u, x in factors[0].items()}
    got = {}
    for r in recommend.best_of(model, indexers, 5).collect():
        got.setdefault(r["user_id"], []).append((r["episode_id"], r["als_score"]))
    assert set(got) == set(scores)
    for user, best in got.items():
        assert len(best) == 5 and all(abs(scores[user][e] - x) < 1e-4 for e, x in best)
        assert np.allclose(sorted((x for _, x in best), reverse=True), sorted(scores[user].values(), reverse=True)[:5], atol=1e-4)
    assert (np.concatenate([list(x.values()) for x in factors]) >= 0).all()


def test_a_query_in_its_history_takes_no_neighbours_place(spark):
    df = spark.createDataFrame([(x, [1.0, float(i)]) for i, x in enumerate("abcd")], "id string, embedding array<float>").coalesce(1)
    got = knn.top_k(df.where("id = 'a'"), df, 3, exclude_self=True).orderBy("rank").collect()
    assert [r["historical_id"] for r in got] == ["b", "c", "d"]


def test_rows_of_scores_are_more_parts_not_larger_ones(spark, monkeypatch):
    monkeypatch.setattr(recommend, "PART_ROWS", 10)
    history = spark.createDataFrame([(f"u{i}", f"e{j}") for i in range(10) for j in range(3)], "user_id string, episode_id string")
    similar = spark.createDataFrame([(f"n{k}", f"e{j}", 0.5 + k / 100 - j / 10) for k in range(8) for j in range(3)], "new_episode_id string, historical_episode_id string, similarity double")
    whole = recommend.content_scores(history, similar)
    got = {(r["user_id"], r["episode_id"]): round(r["sim_score"], 9) for r in whole.collect()}
    assert got == {(f"u{i}", f"n{k}"): round(0.5 + k / 100, 9) for i in range(10) for k in range(8)}
    assert whole.rdd.getNumPartitions() == 24  # 10 users, 3 episodes, 8 near each
    some = spark.createDataFrame([("u1", "n2"), ("u1", "n2"), ("u3", "none"), ("other", "n1"), (None, "n1")], "user_id string, episode_id string")
    of = recommend.content_scores_of(some, history, similar)
    assert [(r["user_id"], r["episode_id"], round(r["sim_score"], 9)) for r in of.collect()] == [("u1", "n2", 0.52)]
