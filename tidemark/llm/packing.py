"""Packing of token sequences by non-negative least squares.

Documents become pieces of at most a window's tokens. Piece lengths are counted in BINS bins
(a window's worth each 1 / BINS of it, rounded up). All combinations of up to DEPTH bins that
fill a window exactly are columns of a matrix; non-negative least squares finds how often
each should repeat to use up the histogram, the counts are rounded down, and what remains is
packed greedily, the longest first. The histogram and the plan have a fixed size, whatever the
corpus; pieces find their place in the plan by their rank among the pieces of their bin.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.common import SALT, map_batches, ranked, salted, written
from tidemark.llm.tokens import WORD_BPE, unlisted, word_bpe

WINDOW, END_ID, BINS, DEPTH = 4096, 2, 256, 3


def tokenized(docs: DataFrame, path: str = WORD_BPE, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens.

    A document's ids are those of its whole text, then end_id; a null or empty text has end_id
    alone. Only the last piece of a document is shorter than a window. Repeated rows give
    their pieces each. Extra columns are left out.
    """
    doubtful = unlisted(path)
    end = np.array([end_id], "<u4").tobytes()

    def make():
        bpe = word_bpe(path, doubtful)

        def step(batch: pa.RecordBatch) -> dict:
            ids = [bpe.ids(x) + end for x in batch.column("text").to_pylist()]
            pieces = [max(1, -(-len(x) // (4 * window))) for x in ids]
            starts = [k * window for n in pieces for k in range(n)]
            at = np.repeat(np.arange(len(ids)), pieces)
            cut = [ids[i][4 * a : 4 * (a + window)] for i, a in zip(at.tolist(), starts, strict=True)]
            return {"doc_id": batch.column("doc_id").take(pa.array(at)), "start": starts, "length": [len(x) // 4 for x in cut], "ids": cut, "doc_tokens": [len(ids[i]) // 4 for i in at.tolist()]}

        return step

    docs = docs.select("doc_id", "text")
    return map_batches(docs, make, StructType([docs.schema["doc_id"], *StructType.fromDDL("start long, length long, ids binary, doc_tokens long")]))


def combinations(bins: int = BINS, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Every non-increasing tuple of up to depth (at most 3) bin sizes whose sum is bins."""
    out: list[tuple[int, ...]] = [(bins,)]
    if depth >= 2:
        out += [(bins - a, a) for a in range(1, bins // 2 + 1)]
    if depth >= 3:
        out += [(bins - a - b, b, a) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that makes |a x - b| least, by the active set method of Lawson and Hanson."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9 * scale:
            break
        active[j] = True
        while True:
            own = np.flatnonzero(active)
            part = a[:, own]
            try:
                z = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(own)), part.T @ b)
            except np.linalg.LinAlgError:
                z = np.linalg.lstsq(part, b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[own] = z
                break
            down = z <= 0
            old = x[own]
            step = float(np.min(old[down] / np.maximum(old[down] - z[down], 1e-300)))
            x[own] = np.maximum(old + step * (z - old), 0)
            gone = own[down & (x[own] <= 1e-12 * scale)]
            if not len(gone):
                gone = own[down][[int(np.argmin(x[own][down]))]]
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x


@dataclass
class Plan:
    """Patterns (bins in the order of their places) and how often each repeats."""

    patterns: list[tuple[int, ...]]
    repeats: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.repeats)


def plan(histogram: np.ndarray, depth: int = DEPTH) -> Plan:
    """How to pack histogram[k] pieces of k + 1 bins each, all of them, into windows of len(histogram) bins."""
    bins, left = len(histogram), histogram.astype(np.int64).copy()
    out = Plan([], [])
    there = np.flatnonzero(left) + 1
    columns = [c for c in combinations(bins, depth) if all(left[k - 1] for k in c)]
    if columns and len(there):
        a = np.zeros((bins, len(columns)))
        for j, c in enumerate(columns):
            for k in c:
                a[k - 1, j] += 1
        x = nonnegative_least_squares(a, left.astype(float))
        for j in np.argsort(-x, kind="stable"):
            c = columns[j]
            if (n := min([int(x[j] + 1e-6), *(int(left[k - 1]) // c.count(k) for k in c)])) > 0:
                for k in c:
                    left[k - 1] -= n
                out.patterns.append(c)
                out.repeats.append(n)
    while left.any():
        space, pattern = bins, []
        used = np.zeros(bins, np.int64)
        while (fits := np.flatnonzero((left - used)[:space] > 0)).size:
            k = int(fits[-1]) + 1
            # as many of this length as there are and as fit
            n = min(space // k, int(left[k - 1] - used[k - 1]))
            pattern += [k] * n
            used[k - 1] += n
            space -= n * k
        n = int(np.min(left[used > 0] // used[used > 0]))
        left -= n * used
        out.patterns.append(tuple(pattern))
        out.repeats.append(n)
    return out


def _places(p: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """By bin: first ranks of its runs of slots, and the first sequence and the place of each run."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    first, taken = 0, {}
    for pattern, n in zip(p.patterns, p.repeats, strict=True):
        for place, k in enumerate(pattern):
            runs.setdefault(k, []).append((taken.get(k, 0), first, place))
            taken[k] = taken.get(k, 0) + n
        first += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()}


def packed(pieces: DataFrame, window: int = WINDOW, bins: int = BINS, depth: int = DEPTH) -> DataFrame:
    """pieces with sequence_id (from 0, gapless) and offset (tokens before it in its sequence).

    pieces has doc_id, start, length (of 1 to window tokens), doc_tokens and ids or ids_crc32; it is written with
    a salt first. Every piece gets one place; which of pieces alike in all columns has which is left
    open. An empty table gives no rows.
    """
    pieces = written(salted(pieces), "pieces")
    width = -(-window // bins)
    pieces = pieces.withColumn("_bin", F.ceil(F.col("length") / width).cast("int"))
    counts = pieces.groupBy("_bin").count().collect()  # at most `bins` rows
    histogram = np.zeros(-(-window // width), np.int64)
    for row in counts:
        histogram[row["_bin"] - 1] = row["count"]
    places = _places(plan(histogram, depth))
    table = ranked(pieces, ["_bin"], [c for c in pieces.columns if c not in ("_bin", SALT)], "_rank", rows=int(histogram.sum()))
    schema = StructType([*(f for f in table.schema if f.name not in ("_bin", "_rank")), StructField("sequence_id", LongType()), StructField("_place", IntegerType())])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            own, rank = batch.column("_bin").to_numpy(), batch.column("_rank").to_numpy()
            sequence, place = np.empty(len(own), np.int64), np.empty(len(own), np.int32)
            for k in np.unique(own).tolist():
                at = own == k
                firsts, sequences, where = places[k]
                run = np.searchsorted(firsts, rank[at], side="right") - 1
                sequence[at], place[at] = sequences[run] + rank[at] - firsts[run], where[run]
            return {c: batch.column(c) for c in batch.schema.names} | {"sequence_id": pa.array(sequence), "_place": pa.array(place)}

        return step

    before = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return map_batches(table, make, schema).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_place")


def sequences(docs: DataFrame, path: str = WORD_BPE, window: int = WINDOW) -> DataFrame:
    """Pieces of docs with their ids and places. A null or empty text is end_id alone, repeated rows are packed each,
    an empty table gives no rows and extra columns are left out; see tokenized and packed."""
    return packed(tokenized(docs, path, window), window)


def packed_documents(docs: DataFrame, path: str = WORD_BPE) -> DataFrame:
    """Places of all pieces, with a checksum of their ids (ids_crc32) in place of the ids; otherwise as sequences."""
    pieces = tokenized(docs, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces; a null or empty text is its end alone, repeated rows are packed each, an empty table gives no rows."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
