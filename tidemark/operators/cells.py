"""An index of vectors for nearest neighbours by cosine: cells around centres, of which a search looks into a few.

Centres are learned by k-means from a sample of bounded size; every vector is then put into the cell of its nearest centre,
and the index is an ordinary table, written by cell, that grows by appending. A query looks into the cells of its
nearest centres (probes) and its similarities there are exact: what can be missed is a neighbour in a cell that wasn't
looked into. Looking into all cells finds all.

Cells are searched in tiles of a bounded number of vectors, of both sides, so that neither a crowded cell nor a
popular one is one task's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import vectors as V
from tidemark.operators.knn import DECIMALS, K, matrix, tile_best, top_k, unit

#: Cells there are at most: centres go to every task. Vectors of a cell, about, below that.
MOST_CELLS, CELL = 4096, 1000
#: Vectors of the sample for each cell: those of the least hashes of ids.
SAMPLE_A_CELL, ITERATIONS, SEED = 64, 10, 42
PROBES = 8
#: Vectors of a tile of queries and of a cell.
QUERY_TILE, CELL_TILE = 4096, 16_384


def centres(vectors: DataFrame, cells: int | None = None, seed: int = SEED) -> np.ndarray:
    """Centres at length one, learned from at most SAMPLE_A_CELL vectors a cell of vectors (id, embedding); zero vectors and nulls teach nothing."""
    known = vectors.where(F.col("embedding").isNotNull() & (V.norm(F.col("embedding")) > 0))
    cells = max(2, min(MOST_CELLS, cells or known.count() // CELL))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_A_CELL * cells).select(array_to_vector("embedding").alias("features"))
    if sample.isEmpty():
        return np.zeros((1, 1))
    model = KMeans(k=cells, distanceMeasure="cosine", maxIter=ITERATIONS, seed=seed).fit(sample)
    return unit(np.array(model.clusterCenters()))


def _in_cells(vectors: DataFrame, found: np.ndarray, most: int) -> DataFrame:
    """id, embedding and cell of vectors, once for each of their nearest centres."""
    kept = vectors.where(F.col("embedding").isNotNull()).select("id", "embedding")
    schema = StructType([*kept.schema.fields, *StructType.fromDDL("cell int")])
    most = min(most, len(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                x = matrix(batch.column("embedding"))
                s = x @ found.T if x.shape[1] == found.shape[1] else np.zeros((len(x), len(found)))
                near = np.argpartition(-s, most - 1, axis=1)[:, :most]
                rows = pa.array(np.repeat(np.arange(len(x)), most))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), batch.column("embedding").take(rows), pa.array(near.ravel().astype(np.int32))], names=schema.names)

    return kept.mapInArrow(run, schema)


def indexed(vectors: DataFrame, found: np.ndarray) -> DataFrame:
    """id, embedding and cell of every vector that isn't null; a zero vector is in some cell."""
    return _in_cells(vectors, found, 1)


def nearest(queries: DataFrame, index: DataFrame, found: np.ndarray, k: int = K, probes: int = PROBES, exclude_self: bool = True, decimals: int | None = DECIMALS) -> DataFrame:
    """new_id, historical_id, similarity and rank of each query's k nearest of index, in the cells of its nearest centres.

    Both sides have id (string) and embedding; index has cell as well, and is best a written table. Zero queries and null
    vectors have no neighbours, a cell without vectors none to give. Equal similarities go by id.
    """
    sizes = {r["cell"]: r["count"] for r in index.groupBy("cell").count().collect()}  # a row a cell, MOST_CELLS at most
    if not sizes:
        return queries.sparkSession.createDataFrame([], "new_id string, historical_id string, similarity double, rank int")
    if exclude_self and probes >= len(found):  # the whole index, whose tiles then needn't follow its cells: a query goes once to each
        return top_k(queries, index.select("id", "embedding"), k, True, QUERY_TILE, CELL_TILE, decimals)
    asked = _in_cells(queries, found, probes)
    tiles = F.create_map(*(F.lit(x) for c, n in sizes.items() for x in (c, -(-n // CELL_TILE))))
    blocks = max(1, -(-queries.count() // QUERY_TILE))
    part = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = asked.where(F.col("cell").isin(*sizes)).select("id", "embedding", "cell", part(F.lit(blocks)).alias("block"), each(tiles[F.col("cell")]).alias("tile"))
    right = index.select("id", "embedding", "cell", part(tiles[F.col("cell")]).alias("tile"), each(F.lit(blocks)).alias("block"))
    keys = ["cell", "tile", "block"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile_best(k + 1 if exclude_self else k, decimals), "new_id string, historical_id string, similarity double")
    if exclude_self:
        pairs = pairs.where("new_id <> historical_id")
    rank = Window.partitionBy("new_id").orderBy(F.desc("similarity"), "historical_id")
    return pairs.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact's pairs (new_id, historical_id) that found has; 1 if there are none."""
    pair = ["new_id", "historical_id"]
    got = exact.select(*pair).join(found.select(*pair, F.lit(1).alias("hit")), pair, "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    return 1.0 if got is None else got
