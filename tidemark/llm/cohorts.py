"""Cohort retention matrix, kept up to date by signed deltas.

A client's cohort is the block of days of its first starting event, and the matrix counts, by segment,
cohort and period since the start, the clients seen and what they spent. State 0 is computed from
the events known first and written down, one row for each client and period. Later events don't
compute it anew but yield signed rows:

* clients whose start moves to an earlier time have all their rows of state 0 taken back (-1), and rows under
  the new start are added (+1), from all their events;
* for other clients a late event adds to its period, and counts the client there only if state 0 hadn't seen it there.

The sum over state 0 and the signed rows is the matrix of state 1.

Clients that hold over 1/HOT_SHARE of the events are dealt over SALTS parts wherever events are joined by
client. There can't be HOT_SHARE of them, which bounds what is broadcast to find them; everything
else is joined and summed by shuffles.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discarded, written

#: Days of a cohort, and of a period.
DAYS = 3
#: A client with more than this part of all events is dealt over so many parts.
HOT_SHARE, SALTS = 1000, 128
#: The kind of event that starts a client.
START = "purchase"
#: What arrives before this is known to state 0.
CUT = datetime.datetime(2024, 3, 1)

CLICK_COLUMNS = ("click_id", "ts", "arrived_at", "client_id", "kind", "value", "props")
MATRIX = "state int, segment string, cohort long, period long, users long, users_crc32 long, moved long, cents long"
_DAY = 86_400_000_000


def whole(x: Column, n: int) -> Column:
    """floor(x / n) of whole numbers, exactly."""
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a time without a zone, whatever the session's zone is."""
    at = at.cast("timestamp_ntz")
    seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def arrival() -> Column:
    """When a click is known: if 3 divides the crc32 h of click_id, h mod 100 days after arrived_at, else then."""
    h = F.crc32(F.col("click_id").cast("string"))
    return F.col("arrived_at").cast("timestamp_ntz") + F.make_dt_interval(F.when(h % 3 == 0, h % 100).otherwise(F.lit(0)).cast("int"))


def events_of(clicks: DataFrame, cut: datetime.datetime = CUT) -> DataFrame:
    """client, at (microseconds), starts, cents, late (not known before cut) and salt; equal clicks once."""
    once = clicks.where("ts is not null and client_id is not null").select(*CLICK_COLUMNS[:-1], F.unhex(F.sha2("props", 256)).alias("props")).distinct()
    return once.select(
        F.col("client_id").cast("long").alias("client"),
        micros(F.col("ts")).alias("at"),
        F.coalesce(F.col("kind") == START, F.lit(False)).alias("starts"),
        F.coalesce(F.floor(F.lit(100) * F.col("value") + F.lit(0.5)).cast("long"), F.lit(0)).alias("cents"),
        F.coalesce(arrival() >= F.lit(str(cut)).cast("timestamp_ntz"), F.lit(True)).alias("late"),
        F.pmod(F.xxhash64("click_id", "ts", "value"), F.lit(SALTS)).cast("int").alias("salt"),
    )


def with_salts(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written events whose salt is 0 but for hot clients; and these clients, under HOT_SHARE."""
    least = events.count() // HOT_SHARE
    hot = written(events.groupBy(F.col("client").alias("hot")).count().where(F.col("count") > least).select("hot"), "hot_clients")
    found = events.join(F.broadcast(hot), F.col("client") == F.col("hot"), "left")
    return found.withColumn("salt", F.when(F.col("hot").isNotNull(), F.col("salt")).otherwise(F.lit(0))).drop("hot"), hot


def contributions(events: DataFrame, hot: DataFrame, starts: DataFrame) -> DataFrame:
    """client, start, period and cents, from the events of each client of starts (client, start) from its start on."""
    parts = F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = starts.join(F.broadcast(hot), F.col("client") == F.col("hot"), "left").select("client", "start", F.explode(parts).alias("salt"))
    seen = events.join(dealt.hint("merge"), ["client", "salt"]).where("at >= start")
    period = whole(F.col("at") - F.col("start"), DAYS * _DAY)
    return seen.groupBy("client", "start", period.alias("period")).agg(F.sum("cents").alias("cents"))


def starts_of(events: DataFrame, clients: DataFrame) -> DataFrame:
    """client, its start in both states (null: none), segment, shifted (the start isn't the same) and moved (nor the cohort)."""
    cohort = lambda c: whole(whole(F.col(c), _DAY), DAYS)
    first = events.where("starts").groupBy("client").agg(F.min(F.when(~F.col("late"), F.col("at"))).alias("start_0"), F.min("at").alias("start_1"))
    cities = clients.where("client_id is not null").groupBy(F.col("client_id").cast("long").alias("client")).agg(F.min("city").alias("segment"))
    return first.join(cities.hint("merge"), "client", "left").select(
        "client",
        "start_0",
        "start_1",
        F.coalesce("segment", F.lit("")).alias("segment"),
        (~F.col("start_0").eqNullSafe(F.col("start_1"))).alias("shifted"),
        F.coalesce(cohort("start_0") != cohort("start_1"), F.lit(False)).alias("moved"),
    )


def signed_rows(state: DataFrame, events: DataFrame, hot: DataFrame, starts: DataFrame) -> DataFrame:
    """client, start, period, sign, counts (is the client itself counted), cents and of: 'state' (its rows), 'back', 'again', 'added'."""
    changed = starts.where("shifted").select("client", F.col("start_1").alias("start"))
    steady = starts.where("not shifted").select("client", F.col("start_1").alias("start"))
    back = state.join(changed.select("client").hint("merge"), "client", "left_semi")
    again = contributions(events, hot, changed)
    seen = state.select("client", "period", F.lit(True).alias("seen"))
    added = contributions(events.where("late"), hot, steady).join(seen.hint("merge"), ["client", "period"], "left")
    rows = lambda df, of, sign, counts: df.select("client", "start", "period", F.lit(sign).alias("sign"), counts.alias("counts"), "cents", F.lit(of).alias("of"))
    own = F.lit(1)
    return rows(state, "state", 1, own).union(rows(back, "back", -1, own)).union(rows(again, "again", 1, own)).union(rows(added, "added", 1, F.col("seen").isNull().cast("int")))


def retention(clicks: DataFrame, clients: DataFrame, cut: datetime.datetime = CUT) -> DataFrame:
    """The matrix of both states, as MATRIX.

    Clicks that are equal in CLICK_COLUMNS count once, those without ts or client_id not at all; further
    columns are left out. A click without click_id isn't delayed, one without arrived_at is known to state 1 only; a null value
    is no cents. A client of several rows has the least of their cities; without a row or city the
    segment is ''. Clients that never start have no cell; empty tables have none at all.
    """
    events = written(events_of(clicks, cut), "events")
    dealt, hot = with_salts(events)
    starts = written(starts_of(events, clients), "starts")
    first = starts.where("start_0 is not null").select("client", F.col("start_0").alias("start"))
    state = written(contributions(dealt.where("not late"), hot, first), "state_0")
    rows = signed_rows(state, dealt, hot, starts).join(starts.select("client", "segment", "moved").hint("merge"), "client")

    signed = {"users": F.col("sign") * F.col("counts"), "users_crc32": F.col("sign") * F.col("counts") * F.crc32(F.col("client").cast("string")), "cents": F.col("sign") * F.col("cents")}
    sums = lambda s, of, moved: [F.sum(F.when(of, x).otherwise(F.lit(0))).cast("long").alias(f"{c}_{s}") for c, x in (signed | {"moved": F.when(F.col("moved") & (F.col("of") == moved), 1).otherwise(0)}).items()]
    cohort = whole(whole(F.col("start"), _DAY), DAYS)
    cells = rows.groupBy("segment", cohort.alias("cohort"), "period").agg(*sums(0, F.col("of") == "state", "state"), *sums(1, F.lit(True), "again"))
    of_state = lambda s: F.struct(F.lit(s).alias("state"), *(F.col(f"{c}_{s}").alias(c) for c in ("users", "users_crc32", "moved", "cents")))
    both = cells.select("segment", "cohort", "period", F.explode(F.array(of_state(0), of_state(1))).alias("s")).where("s.users > 0")
    out = written(both.select("s.state", "segment", "cohort", "period", "s.users", "s.users_crc32", "s.moved", "s.cents"), "matrix")
    discarded(events, hot, starts, state)
    return out


def op11_cohort_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of clicks by the clients' cities, known on the first of March and in the end."""
    return retention(spark.read.parquet(f"{sf_dir}/clicks.parquet"), spark.read.parquet(f"{sf_dir}/clients.parquet"))
