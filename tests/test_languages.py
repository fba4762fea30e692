"""Languages by ranks of trigrams."""

import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators import languages as L
from tidemark.plans import adapters as A


def plain(rows):
    """Profile by key in plain Python."""
    counts = {}
    for key, text in rows:
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            marked = f"_{word}_"
            counts.setdefault(key, Counter()).update(marked[i : i + 3] for i in range(len(marked) - 2))
    return {k: {g: i for i, g in enumerate(sorted(c, key=lambda g: (-c[g], g))[: L.RANKS], 1)} for k, c in counts.items()}


def test_against_plain_python(spark, small):
    docs = A.table(spark, small, "documents").where("doc_id < 80")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    learned = L.profiles(docs)
    want = plain((lang, text) for _, text, lang in rows)
    assert {(r["lang"], r["gram"], r["rank"]) for r in learned.collect()} == {(k, g, n) for k, v in want.items() for g, n in v.items()}
    own = plain((i, text) for i, text, _ in rows)
    for r in L.detected(docs, learned, "doc_id").collect():
        cost = {k: sum(min(abs(n - v[g]), L.RANKS) if g in v else L.RANKS for g, n in own[r["doc_id"]].items()) for k, v in want.items()}
        best = min(cost, key=lambda k: (cost[k], k))
        assert r["language"] == best and abs(r["cost"] - cost[best] / len(own[r["doc_id"]])) < 1e-9


def test_held_out_accuracy(spark, small):
    docs = A.table(spark, small.replace("0.001", "0.01"), "documents")
    found = L.detected(docs.where("doc_id % 2 = 1"), L.profiles(docs.where("doc_id % 2 = 0")), "doc_id")
    got = found.join(docs, "doc_id").agg(F.avg((F.col("language") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert got[0] >= 0.97 and got[1] == 500


def test_edges(spark):
    docs = spark.createDataFrame([(1, "the house", "en"), (2, "das haus", "de"), (3, None, "de"), (4, "12 !?", None), (None, "the", "en"), (1, "the mouse", None)], "id long, text string, lang string")
    learned = L.profiles(docs)
    got = {r["id"]: r["language"] for r in L.detected(docs.withColumn("lang", F.lit("other")), learned, "id").collect()}
    assert got == {1: "en", 2: "de", 3: None, 4: None, None: None}
    assert L.profiles(docs.limit(0)).count() == 0
    assert {r["language"] for r in L.detected(docs, learned.limit(0), "id").collect()} == {None}
    assert L.detected(docs.limit(0), learned, "id").count() == 0


def test_feeds_without_a_language_are_judged_by_their_words(spark, small):
    from tidemark.sources import feeds

    docs = A.table(spark, small, "documents")
    texts = {r["lang"]: r["text"] for r in docs.where("length(text) between 500 and 900").collect()}
    rows = [("a", None, "1", texts["en"], "u1", 1), ("b", None, "2", texts["de"], "u2", 1), ("c", "EN ", "3", texts["fr"], "u3", 1), ("a", None, "4", texts["en"], "u4", 2), ("d", None, "5", None, "u5", 1)]
    df = spark.createDataFrame(rows, "feed_id string, feed_language string, episode_id string, title string, audio_url string, published long").withColumn("description", F.lit(""))
    got = feeds.newest_episodes(df, profiles=L.profiles(docs)).collect()
    assert sorted((r["feed_id"], r["episode_id"]) for r in got) == [("a", "4"), ("c", "3")]


def test_no_trigram_is_shuffled_and_repeated_ids_agree(spark, small):
    docs = A.table(spark, small, "documents").where("doc_id < 60").select("doc_id", "text", "lang").localCheckpoint()
    learned = L.profiles(docs)
    once = L.detected(docs, learned, "doc_id")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") or "gram" not in plan
    both = L.detected(docs.union(docs.selectExpr("doc_id", "'' as text", "lang")), learned, "doc_id")  # the same texts in two rows each
    rows = lambda df: sorted((r["doc_id"], r["language"], round(r["cost"], 9)) for r in df.collect())
    assert rows(both) == rows(once)
