"""The stream over several files and triggers."""

import datetime
import json

import pytest

from tidemark import schemas
from tidemark.operators import engagement
from tidemark.sources.tables import Table
from tidemark.streaming import events as S


def line(i, ts, event="like", user="u"):
    return json.dumps({"event_id": str(i), "user_id": user, "episode_id": "e", "event": event, "ts": ts})


def write(folder, name, lines):
    (folder / name).write_text("\n".join(lines))


@pytest.fixture
def inbox(tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    return at


def run(spark, tmp_path, inbox, files=1):
    daily = Table(spark, f"file://{tmp_path}/daily", schemas.DAILY_ENGAGEMENT, "day")
    history = Table(spark, f"file://{tmp_path}/history", schemas.USER_HISTORY)
    for q in S.run(spark, S.file_stream(spark, f"file://{inbox}", files), f"file://{tmp_path}/raw", daily, history, f"file://{tmp_path}/checkpoints", once=True):
        q.awaitTermination()
    return daily, history


def test_batches_add_up_and_replays_change_nothing(spark, tmp_path, inbox):
    write(inbox, "1.json", [line(1, "2024-01-01T00:00:00.000+00:00"), line(1, "2024-01-01T00:00:00.000+00:00"), "{broken"])
    daily, history = run(spark, tmp_path, inbox)
    write(inbox, "2.json", [line(1, "2024-01-01T00:00:00.000+00:00"), line(2, "2024-01-01T01:00:00.000+00:00", "complete"), line(3, "2024-01-02T01:00:00.000+00:00", "skip")])
    daily, history = run(spark, tmp_path, inbox)
    got = {(r["user_id"], r["day"]): (r["engagement"], r["num_events"]) for r in daily.read().where("user_id is not null").collect()}
    assert got == {("u", datetime.date(2024, 1, 1)): (5.0, 2), ("u", datetime.date(2024, 1, 2)): (0.0, 1)}
    seen = history.read().first()
    assert (seen["first_seen_at"].hour, seen["last_seen_at"].hour) == (0, 1)
    assert spark.read.parquet(f"file://{tmp_path}/raw").where("event_id is not null").count() == 3
    batch = engagement.weighed(spark.read.parquet(f"file://{tmp_path}/raw").selectExpr("*", "cast(null as int) position_sec"))
    before = sorted(map(tuple, daily.read().collect()), key=str)
    S.apply_batch(batch, 0, daily, history)
    assert sorted(map(tuple, daily.read().collect()), key=str) == before


def test_late_rows_are_dropped(spark, tmp_path, inbox):
    write(inbox, "1.json", [line(1, "2024-01-01T12:00:00.000+00:00")])
    run(spark, tmp_path, inbox)
    write(inbox, "2.json", [line(2, "2024-01-01T12:30:00.000+00:00")])
    run(spark, tmp_path, inbox)
    write(inbox, "3.json", [line(3, "2024-01-01T09:00:00.000+00:00"), line(4, "2024-01-01T11:30:00.000+00:00")])
    run(spark, tmp_path, inbox)
    assert sorted(r["event_id"] for r in spark.read.parquet(f"file://{tmp_path}/raw").collect()) == ["1", "2", "4"]


@pytest.mark.parametrize("bounded", [False, True])
def test_remembered_ids(spark, tmp_path, inbox, bounded):
    def once(name, lines):
        write(inbox, name, lines)
        events = S.deduplicated(S.decoded(S.file_stream(spark, f"file://{inbox}", 1)), bounded=bounded)
        q = events.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1]

    once("1.json", [line(1, "2024-01-01T00:00:00.000+00:00")])
    once("2.json", [line(2, "2024-01-02T00:00:00.000+00:00")])
    kept = once("3.json", [line(3, "2024-01-02T01:00:00.000+00:00")])
    assert kept == (2 if bounded else 3)
    once("4.json", [line(1, "2024-01-02T01:30:00.000+00:00")])
    got = sorted(r["event_id"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    assert got == (["1", "1", "2", "3"] if bounded else ["1", "2", "3"])


def test_raw_rows_start_the_raw_query_alone(spark, small, monkeypatch):
    from tidemark.plans import streams

    monkeypatch.setattr(S, "write_engagement", lambda *a, **k: pytest.fail("the other sink"))
    assert streams.streaming_raw(spark, small).count() == spark.read.parquet(f"{small}/events.parquet").count()
