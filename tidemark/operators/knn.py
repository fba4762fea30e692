"""Top-k cosine neighbours of vectors.

Queries and history are dealt into tiles of a fixed size by hash. Each pair of a query tile and a history tile is one
group, multiplied as matrices, that passes on its k best of each query; the k best of those are kept.
Nothing goes through the driver, and no group grows with the tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vectors as V

K = 3
#: Vectors of a tile, about.
QUERY_TILE, HISTORY_TILE = 4096, 16_384
#: Vectors that the form in expressions may broadcast.
BROADCAST_VECTORS = 20_000
#: Pairs that it may compute, each of which costs microseconds; its queries of a task, and blocks of its history.
EXPRESSION_PAIRS, EXPRESSION_QUERIES, BLOCKS = 10_000_000, 100, 64

#: Parts of a history tile whose maxima bound the k best, and twice what single precision may cost a similarity, at most.
STRIPES, SINGLE = 128, 1e-4
#: Similarities are ranked at so many decimals unless told otherwise, so that ties don't hang on the order of sums.
DECIMALS = 6


def unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + V.EPSILON)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as rows of numbers, from their flat values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1 if len(column) else 0)


def best_places(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k greatest of each row, the greatest first; of equal ones the first columns."""
    k = min(k, s.shape[1])
    if not k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    row, column = np.nonzero(s >= least[:, None])  # more than k where the least is tied
    order = np.lexsort((column, -s[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def near_places(s: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all that are up to slack under a bound that k of the row reach; in order. The bound is the least of the k
    greatest maxima of STRIPES, which costs one look at each."""
    n = s.shape[1]
    width = n // STRIPES
    if width < 2 or k > STRIPES:
        row, column = np.nonzero(np.ones_like(s, bool))
        return row, column
    greatest = s[:, : width * STRIPES].reshape(len(s), STRIPES, width).max(axis=2)
    bound = np.partition(greatest, STRIPES - k, axis=1)[:, STRIPES - k] - slack
    return np.divmod(np.flatnonzero(s >= bound[:, None]), n)


def best_near(q: np.ndarray, h: np.ndarray, single: np.ndarray, k: int, decimals: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and similarity of the k best of h for each of q, at length one; of equal ones the first. single is h in single precision, which rules out
    nearly all; the rest are computed in double precision and rounded."""
    slack = SINGLE + (0 if decimals is None else 10.0**-decimals)
    row, column = near_places(q.astype(np.float32) @ single.T, k, slack)
    s = np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", q[row[a : a + 65_536]], h[column[a : a + 65_536]]) for a in range(0, len(row), 65_536))])
    s = s if decimals is None else np.round(s, decimals)
    order = np.lexsort((column, -s, row))
    row, column, s = row[order], column[order], s[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], column[best], s[best]


def tile_best(k: int, decimals: int | None = None):
    """Of a tile of queries and one of the history, the k best of each query; ties go to the least id."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, q, own, h = left.column("id"), matrix(left.column("embedding")), right.column("id"), matrix(right.column("embedding"))
        names, near, number = [], [], []
        if len(ids) and len(own):
            known = np.flatnonzero(q.any(axis=1))  # a zero vector has no neighbours
            order = pc.array_sort_indices(own.combine_chunks()).to_numpy()
            h = unit(h[order])
            single = h.astype(np.float32)
            for a in range(0, len(known), 256):
                rows = known[a : a + 256]
                row, column, s = best_near(unit(q[rows]), h, single, k, decimals)
                number.append(rows[row])
                names.append(order[column])
                near.append(s)
        at = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((number, np.int64), (names, np.int64), (near, np.float64))]
        return pa.table({"new_id": ids.take(pa.array(at[0])), "historical_id": own.take(pa.array(at[1])), "similarity": at[2]})

    return run


def _tiles(df: DataFrame, n: int, others: int, own: str, other: str) -> DataFrame:
    """id and embedding of df, each row in its tile and once for each tile of the other side."""
    known = df.where(F.col("embedding").isNotNull()).select("id", "embedding")
    dealt = known.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def top_k(queries: DataFrame, history: DataFrame | None, k: int = K, exclude_self: bool = False, query_tile: int = QUERY_TILE, history_tile: int = HISTORY_TILE, decimals: int | None = DECIMALS) -> DataFrame:
    """new_id, historical_id, similarity and rank of each query's k nearest; both sides have id (string) and embedding.

    Without a history (None or empty) the queries are their own, and a query finds itself: unless
    exclude_self, that takes one of its k places and is dropped only then. Zero queries have no
    neighbours; zero history vectors have similarity 0. Equal similarities go by id; they are rounded to so many decimals,
    unless that is None.
    """
    n_history = history.count() if history is not None else 0
    n_queries = queries.count()
    table, n_table = (history, n_history) if n_history else (queries, n_queries)
    n, m = max(1, -(-n_queries // query_tile)), max(1, -(-n_table // history_tile))
    left = _tiles(queries, n, m, "q", "h").groupBy("q", "h")
    right = _tiles(table, m, n, "h", "q").groupBy("q", "h")
    # one place more where a history may hold the query as well
    found = left.cogroup(right).applyInArrow(tile_best(k + 1 if exclude_self else k, decimals), "new_id string, historical_id string, similarity double")
    if exclude_self:
        found = found.where("new_id <> historical_id")
    rank = Window.partitionBy("new_id").orderBy(F.desc("similarity"), "historical_id")
    found = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return found.where("new_id <> historical_id")


def top_k_by_expressions(queries: DataFrame, history: DataFrame, k: int = K, decimals: int | None = DECIMALS) -> DataFrame:
    """As top_k, in expressions alone: every pair is computed in the JVM. A history over BROADCAST_VECTORS, or more than EXPRESSION_PAIRS, go by tiles."""
    n, m = queries.count(), history.count()
    if m > BROADCAST_VECTORS or n * m > EXPRESSION_PAIRS:
        return top_k(queries, history, k, decimals=decimals)
    def at_length_one(df: DataFrame) -> DataFrame:
        known = df.where(F.col("embedding").isNotNull()).select("id", F.transform("embedding", lambda x: x.cast("double")).alias("e"), V.norm(F.col("embedding")).alias("norm"))
        return known.withColumn("e", F.transform("e", lambda x: x / (F.col("norm") + V.EPSILON)))

    q = at_length_one(queries).where("norm > 0").select(F.col("id").alias("new_id"), F.col("e").alias("a"))
    # by number: each row is much work, and adaptive execution would put rows together by their size
    q = q.repartition(max(1, -(-n // EXPRESSION_QUERIES)), "new_id")
    dealt = at_length_one(history).groupBy(F.pmod(F.xxhash64("id"), F.lit(BLOCKS)).alias("block")).agg(F.collect_list(F.struct("id", "e")).alias("b"))

    def scored(h: Column) -> Column:
        cosine = V.dot(F.col("a"), h["e"])
        return F.struct((-(cosine if decimals is None else F.round(cosine, decimals))).alias("s"), h["id"].alias("historical_id"))

    # of each block its k best, so that no more are sorted and shuffled
    best = F.slice(F.array_sort(F.transform("b", scored)), 1, k)
    found = q.join(F.broadcast(dealt)).select("new_id", F.explode(best).alias("r")).select("new_id", "r.historical_id", (F.lit(0.0) - F.col("r.s")).alias("similarity"))
    rank = Window.partitionBy("new_id").orderBy(F.desc("similarity"), "historical_id")
    return found.withColumn("rank", F.row_number().over(rank)).where((F.col("rank") <= k) & (F.col("new_id") != F.col("historical_id")))


def similarities(neighbours: DataFrame, model: str, k: int = K, now: Column | None = None) -> DataFrame:
    """Rows of the similarities table: one a pair and model, with the distance and the time."""
    out = neighbours.select(
        F.col("new_id").alias("new_episode_id"),
        F.col("historical_id").alias("historical_episode_id"),
        "similarity",
        F.lit(k).alias("k"),
        F.lit(model).alias("model"),
        V.distance(F.col("similarity")).alias("distance_embed"),
        (now if now is not None else F.current_timestamp()).alias("created_at"),
    )
    return out.dropDuplicates(["new_episode_id", "historical_episode_id", "model"])
