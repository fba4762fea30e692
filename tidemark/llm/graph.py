"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node it reaches), for each node of the edges u, v (long).

    Each round replaces edges by edges to smaller nodes; none is held by one task, and the
    joins on a node of many edges are split by adaptive execution. Self loops and repeated
    edges are allowed; nulls are left out.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("at")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m")
        small = large.join(least, F.col("u") == F.col("at")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.union(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct(), "small_star")
