"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words, word pairs and pairs with one word between of a text, hashed to
2 ** BITS places, each counted once. FTRL gives each place its own learning rate, and its L1
penalty leaves most weights at zero, so that only few are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches, written
from tidemark.llm.decontamination import word_hashes, words_of
from tidemark.llm.language import fold

BITS = 20
#: Bounds of what is learned from: labelled rows of each label, those of the least hashes, and features of all of them. So
#: the driver holds 4 * TRAIN_FEATURES bytes at most.
TRAIN_ROWS, TRAIN_FEATURES = 5000, 8_000_000
#: Chosen by cross-validation over the training folds alone; see cross_validated.
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 15.0, 1.0, 6
THRESHOLD = 0.3

_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def features(text: str | None) -> np.ndarray:
    """Places of all features of the whole text, repeats included; place 0 is the intercept's and has none."""
    h = word_hashes().of(words_of(text))
    pairs, skips = h[:-1] * _A + h[1:] * _B, h[:-2] * _C + h[2:] * _D
    found = np.concatenate((h, pairs, skips))
    found ^= found >> np.uint64(31)
    return np.maximum(((found * _A) >> np.uint64(64 - BITS)).astype(np.int32), 1)


@dataclass
class Model:
    places: np.ndarray
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class Settings:
    alpha: float = ALPHA
    l1: float = L1
    epochs: int = EPOCHS


def fit(rows: list[tuple[int, np.ndarray]], rates: tuple[float, float] = (1, 1), settings: Settings = Settings()) -> Model:
    """Weights from (label, places); rates: the share of each label's rows that is here, to correct the intercept."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    order, alpha = np.random.default_rng(8), settings.alpha
    for _ in range(settings.epochs):
        for i in order.permutation(len(rows)).tolist():
            label, at = rows[i]
            own_z, own_n = z[at], n[at]
            root = np.sqrt(own_n)
            l1 = np.where(at == 0, 0.0, settings.l1)
            w = np.where(np.abs(own_z) <= l1, 0.0, (np.sign(own_z) * l1 - own_z) / ((BETA + root) / alpha + L2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] = own_z + g - (np.sqrt(own_n + g * g) - root) / alpha * w
            n[at] = own_n + g * g
    l1 = np.full(1 << BITS, settings.l1)
    l1[0] = 0
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / alpha + L2))
    places = np.flatnonzero(w[1:]) + 1
    return Model(places.astype(np.int32), w[places].astype(np.float32), float(w[0] + np.log(rates[0] / rates[1])))


def cross_validated(rows: list[tuple[int, int, np.ndarray]], grid: list[Settings]) -> list[tuple[float, Settings]]:
    """The mean log-loss of each setting, best first, from (fold, label, places): each fold is scored by a model of the
    others. Rows of the held-out fold have no business here."""
    out = []
    for settings in grid:
        losses = []
        for fold_out in sorted({f for f, _, _ in rows}):
            model = fit([(label, at) for f, label, at in rows if f != fold_out], settings=settings)
            table = np.zeros(1 << BITS)
            table[model.places] = model.weights
            for f, label, at in rows:
                if f == fold_out:
                    x = model.intercept + table[at].sum()
                    losses.append(np.logaddexp(0, -x if label else x))
        out.append((float(np.mean(losses)), settings))
    return sorted(out, key=lambda x: x[0])


def sampled(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES) -> tuple[list[tuple], dict[int, int]]:
    """(doc_id, label, places) to learn from, and how many labelled rows of docs each label has.

    Of each label, the rows of the least hashes of doc_id: train_rows at most, and as long as their features stay
    within the label's half of train_features. Repeated ids and rows count each, like any others.
    """
    ids = labels.where("label in (0, 1) and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label"))
    narrow = written(docs.select("doc_id").join(ids, F.col("doc_id") == F.col("_id")).groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("rows")), "labelled")
    counts = {r["label"]: r["n"] for r in narrow.groupBy("label").agg(F.sum("rows").alias("n")).collect()}
    if not counts:
        return [], counts
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    each = [narrow.where(F.col("label") == label).orderBy(*order).limit(train_rows).select(F.col("doc_id").alias("_id"), "label", "rows") for label in counts]
    chosen = each[0] if len(each) == 1 else each[0].union(each[1])  # 2 * train_rows ids at most
    few = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            found = [np.unique(features(x)).astype("<i4") for x in batch.column("text").to_pylist()]
            return {c: batch.column(c) for c in ("doc_id", "label")} | {"n": [len(x) for x in found], "places": [x.tobytes() for x in found]}

        return step

    schema = StructType([few.schema["doc_id"], *StructType.fromDDL("label int, n long, places binary")])
    table = written(map_batches(few, make, schema).withColumn("row", F.monotonically_increasing_id()), "features")
    first = [table.where(F.col("label") == label).select("doc_id", "label", "row", "n").orderBy(*order, "row").limit(train_rows) for label in counts]
    short = first[0] if len(first) == 1 else first[0].union(first[1])
    reached = F.sum("n").over(Window.partitionBy("label").orderBy(*order, "row").rowsBetween(Window.unboundedPreceding, 0))
    within = short.withColumn("reached", reached).where(F.col("reached") <= train_features // 2).select(F.col("row").alias("r"))
    got = table.join(F.broadcast(within), F.col("row") == F.col("r"), "left_semi").orderBy("label", *order, "row").select("doc_id", "label", "places").toLocalIterator()
    return [(r["doc_id"], r["label"], np.concatenate(([0], np.frombuffer(r["places"], "<i4")))) for r in got], counts


def trained(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES) -> Model:
    """A model from the texts of docs whose doc_id is in labels (doc_id, label).

    Only labels 0 and 1 count. Labels without a document and null doc_ids teach nothing. Without rows of both labels
    nothing can be told apart: the score is 0 for all, or 1 if label 1 is the only one.
    """
    rows, counts = sampled(docs, labels, train_rows, train_features)
    taught = [sum(label == x for _, label, _ in rows) for x in (0, 1)]
    if not all(taught):
        return Model(np.empty(0, np.int32), np.empty(0, np.float32), np.inf if taught[1] else -np.inf)
    return fit([(label, at) for _, label, at in rows], (taught[0] / counts[0], taught[1] / counts[1]))


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns keep of docs with score, 0 to 1. Null and empty texts get the intercept's. Repeated rows get equal scores."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.places, model.weights, model.intercept))

    def make():
        places, weights, intercept = shipped.value
        table = np.zeros(1 << BITS, np.float32)
        table[places] = weights

        def score(text: str | None) -> float:
            at = features(text)
            at = np.unique(at[table[at] != 0])
            return float(1 / (1 + np.exp(-np.clip(intercept + table[at].sum(dtype=np.float64), -700, 700))))

        def step(batch: pa.RecordBatch) -> dict:
            return {c: batch.column(c) for c in keep} | {"score": [score(x) for x in batch.column("text").to_pylist()]}

        return step

    schema = StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL("score double")])
    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


def judged(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; learned from labelled rows of other folds.

    Labels without a document, null labels and null doc_ids teach nothing; null and empty texts get the intercept's
    score; repeated rows score alike; an empty table gives no rows; extra columns are left out.
    """
    rows = docs.select("doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    known = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 4) != 2)).select("doc_id", F.col("toxic").alias("label"))
    found = scored(rows, trained(docs.select("doc_id", "text"), known, train_rows), ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; nulls, empty texts, repeated rows and empty tables as in judged."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
