"""Deltas, per-id state and rated streams over several triggers."""

import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.functions import events as E
from tidemark.operators import merges
from tidemark.plans import streams
from tidemark.streaming import deltas as D
from tidemark.streaming import events as S
from tidemark.streaming import once as O
from tidemark.streaming import rated as R


def events(spark, rows):
    return spark.createDataFrame(rows, "user_id string, episode_id string, event string, rating int, position_sec int, ts string").withColumn("ts", F.to_timestamp("ts"))


BATCHES = [
    [("u", "e", "like", None, None, "2024-01-01 10:00:00"), ("u", "e", "skip", None, None, "2024-01-01 12:00:00"), ("v", "e", "rate", 5, None, "2024-01-02 10:00:00")],
    [("u", "e", "like", None, None, "2024-01-01 09:00:00"), ("u", "f", "complete", None, None, "2024-01-03 10:00:00"), (None, "e", "like", None, None, "2024-01-03 10:00:00")],
    [("v", "e", "rate", 2, None, "2024-01-02 11:00:00")],
    [("u", "e", "complete", None, None, "2024-01-05 10:00:00")],
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def state_of(spark, path, order, folds=()):
    daily, history = D.daily_deltas(spark, f"file://{path}/d"), D.history_deltas(spark, f"file://{path}/h")
    for n in order:
        D.append_batch(events(spark, BATCHES[n]), n, daily, history, F.lit("2024-02-01").cast("timestamp"))
        if n in folds:
            daily.fold(), history.fold(keep=1)
    return daily, history


def test_deltas_add_up_in_any_order(spark, tmp_path):
    daily, history = state_of(spark, tmp_path / "a", [0, 1, 2, 3])
    got = {(r["user_id"], r["episode_id"], str(r["day"])): (r["engagement"], r["num_events"]) for r in daily.read().collect()}
    assert got["u", "e", "2024-01-01"] == (6.0, 3) and got["v", "e", "2024-01-02"] == (2.0, 2) and got[None, "e", "2024-01-03"] == (3.0, 1)
    seen = {(r["user_id"], r["episode_id"]): (r["first_seen_at"].isoformat(), r["last_seen_at"].isoformat()) for r in D.history_of(history).collect()}
    assert seen == {("u", "e"): ("2024-01-01T10:00:00", "2024-01-05T10:00:00"), ("u", "f"): ("2024-01-03T10:00:00",) * 2, ("v", "e"): ("2024-01-02T10:00:00",) * 2}
    other = state_of(spark, tmp_path / "b", [3, 1, 0, 2, 1, 1])
    assert rows(other[0].read()) == rows(daily.read()) and rows(D.history_of(other[1])) == rows(D.history_of(history))


def test_last_seen_may_move_back(spark, tmp_path):
    _, history = state_of(spark, tmp_path, [0, 1])
    last = lambda monotone: {r["user_id"]: r["last_seen_at"].hour for r in D.history_of(history, monotone).where("episode_id = 'e'").collect()}
    assert last(False)["u"] == 9 and last(True)["u"] == 10


def test_folds_and_replays_change_nothing(spark, tmp_path):
    plain, folded = state_of(spark, tmp_path / "a", [0, 1, 2, 3]), state_of(spark, tmp_path / "b", [0, 1, 2, 3], folds=(1, 2, 3))
    assert rows(plain[0].read()) == rows(folded[0].read()) and rows(D.history_of(plain[1])) == rows(D.history_of(folded[1]))
    assert not folded[0].append(events(spark, BATCHES[0]), 0)  # folded already
    D.append_batch(events(spark, BATCHES[3]), 3, *folded)
    assert rows(plain[0].read().drop("created_at", "updated_at")) == rows(folded[0].read().drop("created_at", "updated_at"))
    assert len(list((tmp_path / "b/d/folded").iterdir())) == 2 and not (tmp_path / "b/d/batch=0").exists()
    assert folded[0].fold() == 3 and D.daily_deltas(spark, f"file://{tmp_path}/none").read().count() == 0


def test_deltas_are_as_large_as_their_batch(spark, tmp_path):
    daily = D.daily_deltas(spark, f"file://{tmp_path}/d")
    size = lambda n: sum(p.stat().st_size for p in (tmp_path / f"d/batch={n}").glob("*.parquet"))
    many = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("user_id"), F.lit("e").alias("episode_id"), F.current_date().alias("day"), F.lit(1.0).alias("engagement"), F.lit(1).cast("long").alias("num_events"), *(F.current_timestamp().alias(c) for c in ("last_ts", "created_at", "updated_at")))
    daily.append(many, 0)
    daily.append(many.limit(60), 1)
    assert size(1) < size(0) / 50 and daily.read().count() == 60_000
    assert {r["num_events"]: r["count"] for r in daily.read().groupBy("num_events").count().collect()} == {1: 59_940, 2: 60}


def test_deltas_agree_with_merges(spark, tmp_path):
    _, history = state_of(spark, tmp_path, [0, 1, 2, 3])
    table = spark.createDataFrame([], "user_id string, episode_id string, first_seen_at timestamp, last_seen_at timestamp")
    for batch in BATCHES:
        new = events(spark, batch).where(E.positive_interest() & F.col("user_id").isNotNull()).groupBy("user_id", "episode_id").agg(F.max("ts").alias("last_ts"))
        table = spark.createDataFrame(merges.set_on_insert(["user_id", "episode_id"])(table, new).collect(), table.schema)
    assert rows(table) == rows(D.history_of(history))


def line(i, ts):
    return json.dumps({"event_id": i, "user_id": "u", "event": "like", "ts": ts})


def test_state_of_ids(spark, tmp_path):
    """Late rows, an id after its time, rows without an id, and a start anew."""
    (tmp_path / "in").mkdir()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    O.with_rocksdb(spark)

    def sent(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(lines))
        source = S.decoded(S.file_stream(spark, f"file://{tmp_path}/in", 1)).select("event_id", "ts")
        q = O.once_an_id(source).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        found = spark.read.schema("event_id string, ts timestamp").parquet(f"file://{tmp_path}/out")
        return sorted((r["event_id"] or "-", r["ts"].strftime("%d %H:%M") if r["ts"] else "-") for r in found.collect())

    try:
        first = [("-", "01 00:10"), ("a", "01 00:00"), ("b", "01 00:05")]
        got = sent("1", line("a", "2024-01-01T00:00:00.000Z"), line("a", "2024-01-01T00:01:00.000Z"), line("b", "2024-01-01T00:05:00.000Z"), line(None, "2024-01-01T00:10:00.000Z"), line(None, "2024-01-01T00:10:00.000Z"))
        assert got == first
        # a start anew: a is remembered; the watermark is 22:10 of the day before, so nothing is late
        assert sent("2", line("a", "2024-01-01T00:30:00.000Z"), line("c", "2023-12-31T22:30:00.000Z"), line("d", "2024-01-01T10:00:00.000Z")) == sorted([*first, ("c", "31 22:30"), ("d", "01 10:00")])
        # the watermark is 08:00: e is late, and a (00:00 and two hours) is forgotten
        got = sent("3", line("e", "2024-01-01T07:59:00.000Z"), line("f", "2024-01-01T08:01:00.000Z"), line("d", "2024-01-01T10:30:00.000Z"))
        assert [x for x in got if x[0] in "ef"] == [("f", "01 08:01")] and ("d", "01 10:30") not in got
        assert ("a", "01 11:00") in sent("4", line("a", "2024-01-01T11:00:00.000Z"))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


@pytest.fixture
def listened(spark):
    sizes = R.BatchSizes()
    spark.streams.addListener(sizes)
    yield sizes
    spark.streams.removeListener(sizes)


def test_rates_and_triggers(spark, tmp_path, listened):
    """At most 200 records a trigger, by the processing time's trigger, and going on where a stopped query was."""
    table = f"file://{tmp_path}/t"
    spark.range(0, 900, 1, 5).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("x")).where("id < 300 or id >= 400").write.parquet(table)

    def run(seconds):
        q = R.rated_stream(spark, table, "id").writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(processingTime=f"{seconds} seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        time.sleep(1)

    run(5)
    assert listened.rows == [200, 200, 200, 200]
    seconds = [float(x[17:-1]) for x in listened.starts]
    assert seconds[3] % 5 < 0.5  # triggers are at the interval's multiples, but after a batch that took longer
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 800
    spark.range(900, 950).select(F.col("id"), F.lit("new").alias("x")).write.mode("append").parquet(table)
    run(0)
    got = spark.read.parquet(f"file://{tmp_path}/out")
    assert listened.rows[4:] == [50] and (got.count(), got.select("id").distinct().count()) == (850, 850)


def test_a_long_table_goes_by_ranges_of_whole_triggers(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    spark.range(0, 2000, 1, 5).select((F.col("id") * 3).alias("id"), F.lit("x").alias("x")).where("id % 7 <> 0").write.parquet(table)
    ids = sorted(r["id"] for r in spark.read.parquet(table).select("id").collect())
    found = R.ranges_of(spark.read.parquet(table), "id", most=100, streams=3, triggers=2)
    assert [x[2] for x in found] == [0, 6, 12] and [x[1] for x in found[:2]] == [ids[599], ids[1199]] == [x[0] for x in found[1:]]
    batches = {}
    for over, upto, first in found:
        q = R.rated_stream(spark, table, "id", 100, 1, over, upto).writeStream.foreachBatch(lambda b, n, first=first: batches.setdefault(first + n, sorted(r["id"] for r in b.collect()))).option("checkpointLocation", f"file://{tmp_path}/c{first}").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    assert batches == {k: ids[100 * k : 100 * k + 100] for k in range(-(-len(ids) // 100))}
    again = spark.read.parquet(table).union(spark.range(3, 6, 3).select("id", F.lit("x")))
    assert len(R.ranges_of(again, "id", most=100, streams=3, triggers=2)) == 1  # offsets repeat


class Sources(StreamingQueryListener):
    """What the streams that ran read."""

    def __init__(self):
        self.found = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.found |= {(str(event.progress.id), s.description) for s in event.progress.sources}

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def test_rated_events_need_no_process_a_stream_and_no_reader_but_spark(spark, tmp_path, monkeypatch):
    """By a path that only Spark opens, three streams and none of them with a Python process; ids repeat and are null."""
    spark.range(0, 970, 1, 5).selectExpr("IF(id % 97 = 0, NULL, (id * 31) % 970 DIV 3) AS event_id", "'view' AS event_type", "'x' AS props").write.parquet(f"file://{tmp_path}/events.parquet")
    ids = sorted((r["event_id"] for r in spark.read.parquet(f"file://{tmp_path}/events.parquet").collect()), key=lambda x: (x is None, x))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.rated.link./in", f"file://{tmp_path}")
    monkeypatch.setattr(streams, "A_TRIGGER", 20)
    spark.streams.addListener(listener := Sources())
    try:
        got = streams.rated_events(spark, "viewfs://rated/in").collect()
        time.sleep(1)
    finally:
        spark.streams.removeListener(listener)
    order = lambda x: (x[0], x[1] is None, x[1])
    assert sorted(((r["batch"], r["event_id"]) for r in got), key=order) == [(k // 20, x) for k, x in enumerate(ids)]
    assert len(listener.found) == 3 and not [x for _, x in listener.found if "Python" in x]


def test_files_of_a_trigger_are_taken_in_the_order_of_offsets(spark, tmp_path):
    table = spark.range(0, 1010, 1, 7).select(((F.col("id") * 397) % 1010).alias("at"))
    found, batches = R.cut(table, "at", most=100, streams=3, triggers=2), {}
    assert [first for _, first in found] == [0, 4, 8]
    for folder, first in found:
        R.file_a_trigger(spark, folder, "at long").writeStream.foreachBatch(lambda b, n, first=first: batches.setdefault(first + n, sorted(r["at"] for r in b.collect()))).option("checkpointLocation", f"file://{tmp_path}/c{first}").trigger(availableNow=True).start().awaitTermination()
    assert batches == {k: list(range(100 * k, min(100 * k + 100, 1010))) for k in range(11)}
    assert R.cut(table.where("false"), "at") == []


def test_a_bucket_of_ids_is_one_call_and_one_state():
    import pandas as pd

    class Handle:
        held, timers, updates = None, [], 0

        def getValueState(self, name, schema):
            return self

        def get(self):
            return self.held

        def update(self, value):
            self.held, self.updates = value, self.updates + 1

        def clear(self):
            self.held = None

        def registerTimer(self, at):
            self.timers = [*self.timers, at]

        getExpiryTimeInMs = lambda self: self.timers[0]
        getCurrentWatermarkInMs = lambda self: 10_000

    from pyspark.sql.types import StructType

    one = Handle()
    own = O.FirstOfId(5000, "id", "ts", StructType.fromDDL("id string, ts timestamp"))
    own.init(one)
    times = pd.to_datetime([11_000, 12_000, 13_000, 9000, 14_000, 30_000], unit="ms", utc=True)
    batch = pd.DataFrame({"id": ["a", "b", "a", "late", None, "c"], "ts": times})
    got = [x for part in own.handleInputRows((1,), iter([batch, batch]), one) for x in part["id"]]
    assert [x if isinstance(x, str) else None for x in got] == ["a", "b", None, "c"] and one.updates == 1 and one.timers == [16_000]
    assert not list(own.handleExpiredTimer((1,), one, one))
    assert one.held == (["b", None, "c"], [17_000, 19_000, 35_000]) and one.timers == [16_000, 17_000]
