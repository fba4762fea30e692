"""The cohort matrix by signed rows against one computed anew in plain Python."""

import datetime
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import cohorts

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
T0 = datetime.datetime(1970, 1, 1)
CUT = datetime.datetime(2024, 3, 1)


def crc(x):
    return zlib.crc32(str(x).encode())


def micros(t):
    return (t - T0) // datetime.timedelta(microseconds=1)


def brute(rows, cities):
    known = []
    for click_id, ts, arrived, client, kind, value, _ in set(rows):
        if ts is None or client is None:
            continue
        h = 1 if click_id is None else crc(click_id)
        at = None if arrived is None else arrived + datetime.timedelta(days=h % 100 if h % 3 == 0 else 0)
        cents = 0 if value is None else int((100 * value + 0.5) // 1)
        known.append((at is not None and at < CUT, client, micros(ts), kind, cents))
    starts = [{}, {}]
    for early, client, us, kind, _ in known:
        for s in (0, 1):
            if kind == "purchase" and (early or s):
                starts[s][client] = min(us, starts[s].get(client, us))
    cohort = lambda us: us // 86_400_000_000 // 3
    cells = defaultdict(lambda: [set(), 0])
    for s in (0, 1):
        for early, client, us, _, cents in known:
            if (early or s) and us >= starts[s].get(client, us + 1):
                start = starts[s][client]
                cell = cells[s, min((c for c in cities.get(client, []) if c is not None), default=""), cohort(start), (us - start) // (3 * 86_400_000_000)]
                cell[0].add(client)
                cell[1] += cents
    moved = {c for c in starts[0] if cohort(starts[0][c]) != cohort(starts[1][c])}
    return {(*k, len(u), sum(map(crc, u)), len(u & moved), cents) for k, (u, cents) in cells.items()}


def made(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        ts = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=r.randrange(110), seconds=r.choice([0, r.randrange(86_400)]), microseconds=r.choice([0, 999_999, 1]))
        arrived = ts + datetime.timedelta(seconds=r.randrange(4))
        rows.append((r.choice([i, i, i, None]), r.choice([ts] * 9 + [None]), r.choice([arrived] * 9 + [None]), r.choice([0, 0, 0, r.randrange(30), None]), r.choice(["purchase", "view", "click", None]), r.choice([1.005, 2.5, -0.125, None, 1e6]), r.choice([None, "{}"])))
    return rows + rows[: n // 5]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_signed_rows_give_the_matrix(spark, zone):
    rows = made(3, 1500) + [(9001, datetime.datetime(1969, 12, 30, 5), datetime.datetime(2024, 1, 1), 77, "purchase", 1.0, None)]
    cities = [(c, f"city{c % 4}") for c in range(25)] + [(3, "a"), (3, None), (5, "zz"), (None, "x")]
    by_client = defaultdict(list)
    for c, city in cities:
        by_client[c].append(city)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clicks = spark.createDataFrame([(*r, "other") for r in rows], SCHEMA + ", segment string")
        got = cohorts.retention(clicks, spark.createDataFrame([(c, x, "other") for c, x in cities], "client_id long, city string, client string"))
        assert got.columns == ["state", "segment", "cohort", "period", "users", "users_crc32", "moved", "cents"]
        want = brute(rows, by_client)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
        assert any(x[6] for x in want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_clients_in_parts_agree(spark, monkeypatch):
    clicks = spark.createDataFrame(made(4, 800), SCHEMA)
    clients = spark.createDataFrame([(0, "a"), (1, "b")], "client_id long, city string")
    want = {tuple(r) for r in cohorts.retention(clicks, clients).collect()}
    monkeypatch.setattr(cohorts, "HOT_SHARE", 1)  # no client has more than all
    assert {tuple(r) for r in cohorts.retention(clicks, clients).collect()} == want


def test_no_clicks(spark):
    clicks = spark.createDataFrame([], SCHEMA)
    clients = spark.createDataFrame([], "client_id long, city string")
    assert cohorts.retention(clicks, clients).collect() == []
    only = spark.createDataFrame([(1, CUT, CUT, 5, "view", 1.0, None), (2, None, CUT, 5, "purchase", 1.0, None)], SCHEMA)
    assert cohorts.retention(only, clients).collect() == []  # no start
