"""Plans that hold at scale: pruned scans, pushed filters, limits before shuffles, partial aggregation."""

import contextlib
import io

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import dashboard, recommend
from tidemark.plans import adapters as A
from tidemark.sources.tables import Table


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scans_read_the_columns_in_use_only(spark, small):
    text = plan(A.history(spark, small))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text
    assert "partial_max(ts" in text  # added up before the shuffle


def test_trailing_window_is_pushed_to_the_scan(spark, small):
    events = A.table(spark, small, "events").withColumn("event_id", F.col("event_id"))
    assert "GreaterThanOrEqual(ts," in plan(dashboard.trailing(events, 30))


def test_days_are_pruned(spark, tmp_path):
    spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.col("id").alias("event_id")).withColumn("ts", F.col("day").cast("timestamp")).write.partitionBy("day").parquet(f"file://{tmp_path}/e")
    got = dashboard.trailing(spark.read.parquet(f"file://{tmp_path}/e"), 1440)
    assert got.count() == 2 and "PartitionFilters: [isnotnull(day" in plan(got)


def test_top_n_limits_each_user_before_the_shuffle(spark):
    df = spark.createDataFrame([("u", "e", 1.0)], "user_id string, recommended_episode_id string, score double")
    assert "WindowGroupLimit" in plan(recommend.top_n(df, 3))


def test_merges_of_a_day_leave_other_days_alone(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", schemas.DAILY_ENGAGEMENT, "day")
    rows = lambda day: spark.sql(f"select 'u' user_id, 'e' episode_id, date'{day}' day, 1.0D engagement, 1L num_events, timestamp'2024-01-01' last_ts, timestamp'2024-01-01' created_at, timestamp'2024-01-01' updated_at")
    seen = []
    t.append(rows("2024-01-01").union(rows("2024-01-02")))
    t.merge(rows("2024-01-02"), lambda target, source: seen.append(sorted(str(r["day"]) for r in target.collect())) or target.unionByName(source))
    assert seen == [["2024-01-02"]] and t.read().count() == 3


def test_the_window_by_sql_reads_its_days_only(spark, tmp_path):
    spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), *(F.col("id").alias(c) for c in ("event_id", "user_id", "episode_id", "event", "rating"))).withColumn("ts", F.col("day").cast("timestamp")).write.partitionBy("day").parquet(f"file://{tmp_path}/e")
    events = spark.read.parquet(f"file://{tmp_path}/e")
    got = dashboard.trailing_by_sql(spark, dashboard.as_view(events, "window_of_a_test"), 1440)
    assert [r["event_id"] for r in got.collect()] == [8, 9] and "PartitionFilters: [isnotnull(day" in plan(got)
    assert dashboard.trailing_by_sql(spark, dashboard.as_view(events.limit(0), "empty_of_a_test")).count() == 0
