"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1; the vector of an n-gram binds (multiplies) its
letters' vectors, each permuted (rotated) by its place; a text bundles (adds) the vectors of
its n-grams, and a language's prototype bundles the texts of that language, each at length
one. A text gets the language whose prototype has the greatest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches
from tidemark.llm.tokens import worker_cache

DIMENSIONS, GRAM, SEED = 1024, 3, 10
#: Letters share a vector if their code points are equal modulo this prime; 0 stands for what parts words.
LETTERS = 1021
#: Languages whose sums a task holds before it passes them on.
HELD = 1000
UNKNOWN = "und"


def _letters() -> tuple[np.ndarray, list[np.ndarray]]:
    """Of code points, the letter's number or 0; of numbers, the vectors rotated by each place."""
    cache = worker_cache()
    if "letters" not in cache:
        numbers = np.array([1 + i % LETTERS if chr(i).isalpha() else 0 for i in range(0x110000)], np.int32)
        vectors = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (LETTERS + 1, DIMENSIONS))
        cache["letters"] = numbers, [np.roll(vectors, GRAM - 1 - k, axis=1) for k in range(GRAM)]
    return cache["letters"]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the text's n-grams of letters and word bounds, and their counts."""
    numbers, _ = _letters()
    own = numbers[np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)]
    own = np.concatenate(([0], own, [0]))
    own = own[np.concatenate(([True], (own[1:] != 0) | (own[:-1] != 0)))].astype(np.int64)
    if len(own) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = own[: len(own) - GRAM + 1].copy()
    for k in range(1, GRAM):
        code = code * (LETTERS + 1) + own[k : len(own) - GRAM + 1 + k]
    return np.unique(code, return_counts=True)


def bundles(texts: list[str | None]) -> np.ndarray:
    """A row of length one for each text, or of zeros for one without letters."""
    _, rotated = _letters()
    counted = [grams(x) for x in texts]
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for k in range(0, len(texts), 64):  # n-gram vectors are bound once for so many texts
        part = counted[k : k + 64]
        codes, at = np.unique(np.concatenate([c for c, _ in part]), return_inverse=True)
        if not len(codes):
            continue
        bound, rest = None, codes
        for place in reversed(range(GRAM)):
            letters, rest = rotated[place][rest % (LETTERS + 1)], rest // (LETTERS + 1)
            bound = letters if bound is None else bound * letters
        bound, first = bound.astype(np.float32), 0
        for i, (own, n) in enumerate(part):
            if len(own):
                x = n.astype(np.float32) @ bound[at[first : first + len(own)]]
                first += len(own)
                if length := float(np.linalg.norm(x)):
                    out[k + i] = x / length
    return out


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their prototypes of length one, from all rows of text and lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))], names=["lang", "sum"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            vectors = bundles(batch.column("text").to_pylist())
            for lang in dict.fromkeys(langs):
                own = vectors[np.array([x == lang for x in langs])].sum(axis=0, dtype=np.float64)
                sums[lang] = sums[lang] + own if lang in sums else own
                if len(sums) >= HELD:
                    yield out()
                    sums.clear()
        if sums:
            yield out()

    sums = labelled.select("lang", "text").mapInArrow(run, "lang string, sum array<double>")
    rows = sums.select("lang", F.posexplode("sum").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("sum"))  # DIMENSIONS entries a language
    found = {r["lang"]: np.array([x["x"] for x in r["sum"]]) for r in rows.collect()}
    found = {k: x / np.linalg.norm(x) for k, x in sorted(found.items()) if np.linalg.norm(x) > 0}
    return list(found), np.array(list(found.values()), np.float32).reshape(-1, DIMENSIONS)


def predicted(docs: DataFrame, langs: list[str], table: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns keep of docs with lang_pred and score, the cosine with that prototype (0 at least).

    A null text, one without letters, and any text if no language is known get UNKNOWN and 0.
    Of equal cosines the first language in order wins. Repeated rows get equal results.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(table)
    def make():
        own = shipped.value

        def step(batch: pa.RecordBatch) -> dict:
            vectors = bundles(batch.column("text").to_pylist())
            known = vectors.any(axis=1) & bool(len(langs))
            cosines = vectors @ own.T if langs else np.zeros((len(vectors), 1), np.float32)
            best = cosines.argmax(axis=1)
            score = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0).astype(np.float64)
            return {c: batch.column(c) for c in keep} | {"lang_pred": [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], "score": pa.array(score)}

        return step

    schema = StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL("lang_pred string, score double")])
    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned from rows of other folds that have a language."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    langs, table = prototypes(rows.where(~F.col("held_out") & F.col("lang").isNotNull()))
    return predicted(rows.drop("lang"), langs, table, ["doc_id", "held_out"])


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; null texts and those without a letter are und, repeated rows alike, an empty table gives no rows."""
    return identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))
