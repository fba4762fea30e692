"""Arrays cut at every place, against the json library."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import json_arrays as J
from tidemark.sources import records
from tidemark.sources.files import listed

ODD = '[{"a": "x\\\\"}, 5, {"b": "}{][\\"\\\\\\"", "c": {"d": [1, {"e": "é🙂"}]}}, [{"no": 1}], "{", {}, null,\n {"\\\\": "\\\\\\\\"} , {"k": ""}]'


def objects(text):
    return [x for x in json.loads(text) if isinstance(x, dict)]


def cut(data, size):
    """What the two passes do, in plain Python over ranges of so many bytes."""
    out, state, depth = [], J.OUTSIDE, 0
    for start in range(0, len(data), size):
        own = J.Cut(state, depth)
        block = data[start : start + size]
        found, at = list(own.takes(block, True)), start + size
        while own.held and at < len(data):
            found += own.takes(data[at : at + 3], False)
            at += 3
        out += [json.loads(x) for x in found]
        steps, end = J.read_states(np.frombuffer(block, np.uint8), state)
        state, depth = end, depth + int(steps.sum())
    return out


def test_cut_at_every_place():
    data = ODD.encode()
    for size in range(1, len(data) + 2):
        assert cut(data, size) == objects(ODD), size


@pytest.mark.parametrize("seed", range(6))
def test_random_arrays(seed):
    r = random.Random(seed)

    def value(deep):
        kind = r.choice("ssnlo" if deep else "sn")
        if kind == "s":
            return "".join(r.choices('ab"\\{}[],:é\n🙂', k=r.choice([0, 1, 9])))
        if kind == "n":
            return r.choice([1, -2.5, None, True])
        if kind == "l":
            return [value(deep - 1) for _ in range(r.randrange(4))]
        return {value(0) if r.random() < 0.1 else f"k{i}{'{' * r.randrange(2)}": value(deep - 1) for i in range(r.randrange(4))}

    whole = [value(3) for _ in range(60)]
    text = json.dumps(whole, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
    want = [x for x in json.loads(text) if isinstance(x, dict)]
    for size in (1, 2, 3, 7, 64, 10_000):
        assert cut(text.encode(), size) == want


@pytest.mark.parametrize("size", [5, 64, 1 << 20])
def test_files_by_ranges(spark, tmp_path, size):
    (tmp_path / "a.json").write_text(ODD)
    (tmp_path / "b.json").write_text(json.dumps([{"n": i, "t": "[{" * (i % 5)} for i in range(80)], indent=2))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ] ")
    files = listed(spark, f"file://{tmp_path}")
    rows = J.array_objects(files, size).collect()
    assert sorted(json.dumps(json.loads(r["item"]), sort_keys=True) for r in rows) == sorted(json.dumps(x, sort_keys=True) for x in objects(ODD) + json.loads((tmp_path / "b.json").read_text()))
    assert {r["path"].rpartition("/")[2]: r["first"] for r in J.first_characters(files).collect()} == {"a.json": "[", "b.json": "[", "none.json": "["}


def test_many_tasks_read_one_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": str(i), "x": "y" * 200} for i in range(500)]))
    at = listed(spark, f"file://{tmp_path}")
    found = J.array_objects(at, 4096)
    tasks = found.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert found.count() == 500 and len(tasks) > 1
    got = records.json_records(spark, f"file://{tmp_path}", schemas._struct("id string"))
    assert sorted(int(r["id"]) for r in got.collect()) == list(range(500))


def test_one_look_gives_all_states():
    r = random.Random(3)
    for n in (1, 2, 3, 8, 40):
        for _ in range(300):
            data = np.frombuffer("".join(r.choices('a"\\\\{}[],', k=n)).encode(), np.uint8)
            found = [J.read_states(data, s) for s in (J.OUTSIDE, J.INSIDE, J.ESCAPED)]
            assert J.summary(data) == ([e for _, e in found], [int(s.sum()) for s, _ in found])


def test_the_query_writes_a_file_a_task(spark, small):
    """Not one for each 200 pages."""
    from pathlib import Path

    from tidemark.plans import ingestion

    sf = small.replace("0.001", "0.1")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.glob("arrays-*"))
    got = ingestion.json_array_items(spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    (new,) = set(shared.glob("arrays-*")) - before
    assert len(list(new.rglob("part-*"))) <= pages.rdd.getNumPartitions()
    want = pages.select("page_id", "url", F.length("html").cast("long").alias("n"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
