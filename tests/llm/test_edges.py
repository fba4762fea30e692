"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, for every operator."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language, packing, pii, quality, scoring, sharding, simhash, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
WORDS = "the quick brown fox jumps over the lazy dog while a grey cat looks on from an old wall near this house"
ROWS = [
    (1, WORDS, "en", "a", 10),
    (1, WORDS, "en", "a", 10),
    (2, WORDS + " today", "en", "a", 10),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", "b", 0),
    (6, LONG, "en", "b", 10),
    (None, "der die das und nicht ein eine mit von zu auf ist im dem", "de", "a", 10),
    (None, None, None, None, None),
    (7, "x@y.org 1.2.3.4 +49 30 1234567 4111111111111111", None, "b", 5),
]
CLASHING = ("bits", "node", "root", "h2", "trainer", "of", "fingerprint", "component_id", "kept", "base_failed", "n_words", "hit_spans", "spans", "score", "shard", "slot", "label", "h", "fp", "_row", "sequence_id", "offset", "held_out")


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    clash = docs
    for c in CLASHING:
        clash = clash.withColumn(c, F.lit("other"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (99, 1, 1), (6, 1, None)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, WORDS), (2, None), (3, ""), (4, "grey cat looks"), (None, "quick brown"), (1, WORDS)], "item_id long, text string")
    return {"docs": docs, "empty": docs.limit(0), "clash": clash, "labels": labels, "benchmark": benchmark}


def operators(t):
    return {
        1: lambda d: pii.spanned(d.select("doc_id", "text")),
        2: simhash.near_duplicates,
        3: token_counts.document_counts,
        4: lambda d: decontamination.scanned(d, t["benchmark"]),
        5: sharding.sharded,
        6: scoring.pseudo_likelihood,
        7: quality.judged,
        8: lambda d: toxicity.judged(d, t["labels"]),
        9: packing.packed_documents,
        10: language.identified,
    }


@pytest.mark.parametrize("n", range(1, 11))
@pytest.mark.parametrize("kind", ["docs", "empty", "clash"])
def test_every_row_has_its_result(tables, n, kind):
    docs = tables[kind]
    rows = operators(tables)[n](docs).collect()
    if n == 9:  # the long text has many pieces
        assert len({(r["doc_id"], r["ids_crc32"]) for r in rows if r["start"] == 0}) == (0 if kind == "empty" else 9)
        rows = [r for r in rows if r["start"] == 0]
    assert len(rows) == (0 if kind == "empty" else len(ROWS))


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("kind", ["docs", "empty", "clash"])
def test_stages(spark, tables, tmp_path, name, kind):
    tables["benchmark"].write.parquet(f"file://{tmp_path}/benchmark.parquet")
    found = dict(corpus_pipeline.STAGES)[name](spark, tables[kind], f"file://{tmp_path}")
    if name != "packing":
        assert found.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert (found.count() == 0) == (kind == "empty")


def test_one_of_each_component_stays(tables):
    rows = simhash.near_duplicates(tables["docs"]).collect()
    kept = simhash.deduplicated(tables["docs"]).collect()
    assert len(kept) == len({(r["component_id"], r["component_id"] is None and r["fingerprint"]) for r in rows})
    assert [r["doc_id"] for r in kept].count(1) == 1  # of a row that repeats
    assert [r["doc_id"] for r in kept].count(3) == 1  # of texts without words


def test_private_columns_stay(tables):
    docs = tables["docs"].withColumns({c: F.lit(c) for c in ("_id", "_fp", "_node", "_bucket", "copies", "head")})
    kept = simhash.deduplicated(docs).collect()
    assert len(kept) == len(simhash.deduplicated(tables["docs"]).collect()) and {(r["_id"], r["_fp"], r["copies"]) for r in kept} == {("_id", "_fp", "copies")}
    assert {(r["_node"], r["_id"]) for r in sharding.assign(docs, sharding.topology(24)).collect()} == {("_node", "_id")}


def test_null_and_empty_results(tables):
    assert {r["n_words"] for r in quality.judged(tables["docs"]).where("text is null or trim(text) = ''").collect()} == {0}
    assert {r["lang_pred"] for r in language.identified(tables["docs"]).where("doc_id in (3, 4, 5)").collect()} == {"und"}
    assert [r["spans"] for r in pii.spanned(tables["docs"].select("doc_id", "text")).where("doc_id = 3").collect()] == [[]]
    assert {r["fingerprint"] for r in simhash.near_duplicates(tables["docs"]).where("doc_id in (3, 4, 5)").collect()} == {0}
    assert {r["n_tokens"] for r in token_counts.document_counts(tables["docs"]).where("doc_id in (3, 4)").collect()} == {0}
    assert {(r["n_tokens"], r["mean_log_prob"]) for r in scoring.pseudo_likelihood(tables["docs"]).where("doc_id in (3, 4, 5)").collect()} == {(0, None)}
    assert {r["size"] for r in sharding.sharded(tables["docs"]).where("doc_id = 3").collect()} == {8}
    hits = {r["doc_id"]: r for r in decontamination.scanned(tables["docs"], tables["benchmark"]).where("doc_id < 4").collect()}
    assert hits[1]["hit_items"] == ["1", "4"] and [tuple(x) for x in hits[1]["hit_spans"]] == [(0, 22)]
    assert (hits[3]["n_words"], hits[3]["hit_spans"]) == (0, [])
