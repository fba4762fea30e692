"""Sharding by a hierarchical weighted hash tree.

A row descends regions, racks and shards. At each level every child makes a weighted hash
draw for the row, -ln(u) / weight with u in (0, 1) hashed from the row's key and the
child's path, and the least draw wins. A child wins in proportion to its weight, and a
changed weight moves only rows between that child and its siblings, below the nodes
whose weights are unchanged.

A grown tree takes its new shard as a region of its own: the draws of the other nodes
stay as they were, so the only rows that move are those that the new region wins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import private, ranked, salted, written

#: Production topology: shards of a rack, racks of a region.
SHARDS_A_RACK, RACKS_A_REGION = 4, 2
SHARDS = 24


@dataclass(frozen=True)
class Node:
    """A node of the tree: a shard if it has no children. Its weight is its shards' sum."""

    name: str
    children: tuple[Node, ...] = field(default=())
    own_weight: float = 1.0
    shard: int = -1

    @property
    def weight(self) -> float:
        return sum(x.weight for x in self.children) if self.children else self.own_weight


def topology(shards: int, grown: int = 0, weights: dict[int, float] | None = None) -> Node:
    """A tree over `shards` shards in racks and regions, then `grown` more, each a region of its own."""
    leaf = lambda i: Node(f"shard{i}", own_weight=(weights or {}).get(i, 1.0), shard=i)
    regions: list[Node] = []
    a_region = SHARDS_A_RACK * RACKS_A_REGION
    for r in range(math.ceil(shards / a_region)):
        own = range(r * a_region, min((r + 1) * a_region, shards))
        racks = [own[k : k + SHARDS_A_RACK] for k in range(0, len(own), SHARDS_A_RACK)]
        regions.append(Node(f"region{r}", tuple(Node(f"rack{k}", tuple(leaf(i) for i in rack)) for k, rack in enumerate(racks))))
    regions += [Node(f"grown{i}", (Node("rack0", (leaf(i),)),)) for i in range(shards, shards + grown)]
    return Node("root", tuple(regions))


def _draw(key: Column, path: str, weight: float) -> Column:
    # 52 bits of the hash, moved off 0 and 1
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(path), key), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.lit(float(weight))


def _live(node: Node) -> list[Node]:
    return [x for x in node.children if x.weight > 0]


def assign(docs: DataFrame, tree: Node, key: str = "doc_id", column: str = "shard") -> DataFrame:
    """docs with the shard of each row, found level by level. Equal keys share a shard; a null key is hashed as
    the word null, so all rows of null keys share one. Nodes without weight take no rows."""
    if tree.weight <= 0:
        raise ValueError("the tree has no shard of a weight over 0")
    text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    level = [(tree.name, tree)]  # where rows can be, by path
    (at,) = private(docs, "_node")
    out = docs.withColumn(at, F.lit(0))
    while any(node.children for _, node in level):
        below: list[tuple[str, Node]] = []
        choice = None
        for i, (path, node) in enumerate(level):
            live = _live(node) if node.children else [node]
            draws = [F.struct(_draw(text, f"{path}/{x.name}", x.weight).alias("draw"), F.lit(len(below) + k).alias("child")) for k, x in enumerate(live)]
            won = F.array_min(F.array(*draws))["child"] if len(live) > 1 else F.lit(len(below))
            choice = F.when(F.col(at) == i, won) if choice is None else choice.when(F.col(at) == i, won)
            below += [(f"{path}/{x.name}" if node.children else path, x) for x in live]
        out, level = out.withColumn(at, choice), below
    shards = F.array(*(F.lit(node.shard) for _, node in level))
    return out.withColumn(column, F.get(shards, F.col(at))).drop(at)


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with one shard more) and slot, gapless from 0 in each shard.

    A null text has 8 bytes and the checksum of no bytes. Repeated rows are kept, each with
    a slot. Extra columns are left out. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = assign(assign(rows, topology(shards)), topology(shards, 1), column="grown_shard")
    return ranked(written(salted(rows), "sizes"), ["shard"], ["doc_id", "text_crc32", "size", "grown_shard"], "slot")  # narrow, so that texts are read once


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, tree: Node | None = None) -> None:
    """Whole rows to folders shard=0, shard=1, ... of Parquet files, without a shuffle. Nulls and repeated rows as in assign; an empty table
    makes no folder. A column shard gives way; other extra columns are written too."""
    assign(docs, tree or topology(shards)).write.partitionBy("shard").mode("overwrite").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in 24 shards, by key; nulls, repeated rows and empty tables as in sharded."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sharded(docs).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
