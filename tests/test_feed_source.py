"""The data source of feeds."""

import json
import sys

import pytest
from pyspark import cloudpickle

from tidemark.sources import feed_source as FS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feed(i, items=(), **more):
    return {"id": i, "title": f"t{i}", "author": None, "language": "en", "items": list(items)} | more


def item(i, **more):
    return {"id": i, "title": f"e{i}", "description": {"html": "x"}, "enclosureUrl": f"http://a/{i}", "datePublished": i} | more


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"feeds": [feed(1, [item(10), item(11)]), feed(2)]}))
    (tmp_path / "b.json").write_text("\n".join([json.dumps(feed(3, [item(12, enclosureUrl=None)])), "{broken", "", "[1, 2]", json.dumps({"title": "no id"}), json.dumps(feed(4, [item(13), "odd"]))]))
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "empty.json").write_text("")
    return f"file://{tmp_path}"


def test_a_partition_a_file_and_error_rows(spark, folder):
    found = FS.feeds(spark, folder)
    assert found.rdd.getNumPartitions() == 3
    rows = found.collect()
    good = {(r["feed_id"], r["episode_id"]): r for r in rows if r["error"] is None}
    assert set(good) == {("1", "10"), ("1", "11"), ("2", None), ("3", "12"), ("4", "13")}
    assert good["3", "12"]["audio_url"] is None and good["1", "10"]["description"] == '{"html": "x"}' and good["1", "11"]["published"] == 11
    bad = [r for r in rows if r["error"]]
    assert sorted(r["line"] for r in bad) == [1, 3, 4] and all(r["address"].endswith("b.json") for r in bad)


def test_addresses_that_cant_be_fetched(spark, folder):
    def fetch(address):
        if "down" in address:
            raise TimeoutError("no answer")
        return [json.dumps(feed(address, [item(1)]))]

    FS.registered(spark, fetch, "net_feeds")
    rows = spark.read.format("net_feeds").option("addresses", json.dumps(["x", "down", "y"])).load().collect()
    assert {(r["address"], r["feed_id"], r["error"]) for r in rows} == {("x", "x", None), ("y", "y", None), ("down", None, "TimeoutError: no answer")}
    with pytest.raises(Exception, match="nowhere"):
        FS.feeds(spark, "file:///nowhere").collect()


def test_filters_leave_out_partitions(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        one = FS.feeds(spark, folder).where(f"address = '{folder}/a.json'")
        assert one.rdd.getNumPartitions() == 1 and one.count() == 3
        assert FS.feeds(spark, folder).where(f"address in ('{folder}/a.json', '{folder}/b.json') and feed_id = '3'").count() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
