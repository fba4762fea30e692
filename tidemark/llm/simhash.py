"""Near-duplicates by SimHash, with candidates from a pigeonring.

The 64 bits lie on a ring of 7 segments. If two fingerprints differ in at most 4 bits, the
pigeonring principle gives a segment from which every chain of l consecutive segments
differs in at most l * 4 / 7 bits: 0, 1, 1, 2, 2, 3, 4 for l of 1 to 7. Within its first
five segments such a chain has three that are equal, the first among them, in one of five
patterns. So a fingerprint has 35 keys (7 starts, 5 patterns, about 27 bits each); pairs
that share one are held to the chain's budgets, and only what remains meets the full
Hamming check. No link within the distance is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import map_batches, private, written
from tidemark.llm.graph import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Bits of the ring's segments, from the lowest.
SEGMENTS = (10, 9, 9, 9, 9, 9, 9)
#: Bits that a chain of 1, 2, ... segments may differ in.
BUDGETS = tuple(k * DISTANCE // len(SEGMENTS) for k in range(1, len(SEGMENTS) + 1))
#: The first three equal segments of a chain, counted from its start.
PATTERNS = tuple((0, a, b) for a in range(1, 5) for b in range(a + 1, 5) if a - 1 <= BUDGETS[a - 1] and b - 2 <= BUDGETS[b - 1])
#: Fingerprints of one key that a task holds; a larger key is dealt in tiles, and each pair of tiles is one group.
TILE = 32_768
#: Keys of at most so many fingerprints are compared for a whole batch at once.
SMALL = 12


def _ring() -> list[int]:
    masks, at = [], 0
    for bits in SEGMENTS:
        masks.append(((1 << bits) - 1) << at)
        at += bits
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None) -> int:
    """The signed 64-bit fingerprint of the whole text: 0 if it has no word or is null."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, six characters separate
    n = len(words)
    if not n:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= SHINGLE:
        hashes = np.array([digest(whole, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths).tolist()
        hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):  # bounded, however long the text
        ones += np.unpackbits(hashes[k : k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprinted(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with the column fingerprint (long)."""
    docs = docs.drop("fingerprint")
    names = [c for c in docs.columns if keep_text or c != "text"]
    schema = StructType([*(docs.schema[c] for c in names), StructField("fingerprint", LongType())])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {c: batch.column(c) for c in names} | {"fingerprint": [fingerprint(x) for x in batch.column("text").to_pylist()]}

        return step

    return map_batches(docs, make, schema)


def chain_keys(fp: Column) -> Column:
    """An array of key (its index) and part (the bits of its three segments)."""
    masks, found = _ring(), []
    for start in range(len(SEGMENTS)):
        for pattern in PATTERNS:
            mask = 0
            for k in pattern:
                mask |= masks[(start + k) % len(SEGMENTS)]
            found.append(F.struct(F.lit(len(found)).cast("int").alias("key"), fp.bitwiseAND(F.lit(_signed(mask))).alias("part")))
    return F.array(*found)


def chains(start: int) -> list[tuple[int, int]]:
    """(mask, budget) of the growing chains from a segment, to the whole ring."""
    masks, out, mask = _ring(), [], 0
    for k, most in enumerate(BUDGETS):
        mask |= masks[(start + k) % len(SEGMENTS)]
        out.append((mask, most))
    return out


def _links(differ: np.ndarray, start: np.ndarray | int, tests: np.ndarray) -> np.ndarray:
    """Which XORs of two fingerprints pass every chain from their start; the last chain is the full check."""
    at = np.arange(len(differ))
    for k in range(1, len(BUDGETS)):
        mask = tests[start[at], k] if isinstance(start, np.ndarray) else tests[start, k]
        at = at[np.bitwise_count(differ[at] & mask) <= BUDGETS[k]]
        if not len(at):
            break
    return at


def _forest(fps: np.ndarray, start: int, tests: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of one key's fingerprints. Each is compared with those not reached yet only."""
    rest = fps
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            at = _links(rest ^ x, start, tests)
            if len(at):
                found = rest[at]
                yield np.full(len(at), x), found
                front.extend(found)
                rest = np.delete(rest, at)


def _tests() -> np.ndarray:
    return np.array([[mask for mask, _ in chains(s)] for s in range(len(SEGMENTS))], np.uint64)


class _Union:
    """Fingerprints already linked within a task, so that it names each link between them once."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def new(self, pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
        out = []
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                out.append((a, b))
        if len(self.up) > 2_000_000:  # forgetting only repeats links
            self.up.clear()
        return out


_LINKS = "u long, v long, key int, part long, tile int"


def _link_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of key, part, fp sorted so: links u, v; of a key over TILE, its rows with their tile instead."""
    tests, known = _tests(), _Union()
    starts_of = np.arange(len(SEGMENTS) * len(PATTERNS)) // len(PATTERNS)

    def out(pairs=(), key=None, part=None, fps=(), tile=None):
        n = len(pairs) + len(fps)
        u = [a for a, _ in pairs] + list(fps)
        v = [b for _, b in pairs] + [None] * len(fps)
        columns = [u, v, *([x if len(fps) else None] * n for x in (key, part, tile))]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)], names=["u", "v", "key", "part", "tile"])

    def groups(key, part, fp):
        """Links of whole groups."""
        if len(key) < 2:
            return []
        edge = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        first = np.concatenate(([0], edge))
        sizes = np.diff(np.concatenate((first, [len(key)])))
        group = np.repeat(np.arange(len(first)), sizes)
        bits = fp.view(np.uint64)
        pairs: list[tuple[int, int]] = []
        small = np.flatnonzero((sizes[group] > 1) & (sizes[group] <= SMALL))
        for d in range(1, SMALL):
            i = small[small + d < len(key)]
            i = i[group[i] == group[i + d]]
            if not len(i):
                break
            at = i[_links(bits[i] ^ bits[i + d], starts_of[key[i]], tests)]
            pairs += known.new(zip(fp[at].tolist(), fp[at + d].tolist(), strict=True))
        for g in np.flatnonzero(sizes > SMALL):
            a = first[g]
            for x, y in _forest(bits[a : a + sizes[g]], int(starts_of[key[a]]), tests):
                pairs += known.new(zip(x.view(np.int64).tolist(), y.view(np.int64).tolist(), strict=True))
        return pairs

    held = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))
    tiled = None  # key, part and next tile of a key over TILE
    for batch in batches:
        held = tuple(np.concatenate((x, batch.column(c).to_numpy())) for x, c in zip(held, ("key", "part", "fp"), strict=True))
        while len(held[0]):
            key, part, fp = held
            if tiled and (key[0], part[0]) == tiled[:2]:
                n = int(np.searchsorted(~((key == key[0]) & (part == part[0])), True))
                if n < len(key) or n >= TILE:
                    m = min(n, TILE)
                    yield out(key=int(key[0]), part=int(part[0]), fps=fp[:m].tolist(), tile=tiled[2])
                    tiled = (*tiled[:2], tiled[2] + 1)
                    held = tuple(x[m:] for x in held)
                    continue
                break
            last = len(key) - int(np.searchsorted(~((key == key[-1]) & (part == part[-1]))[::-1], True))
            if last:
                if pairs := groups(key[:last], part[:last], fp[:last]):
                    yield out(pairs)
                held = tuple(x[last:] for x in held)
            if len(held[0]) > TILE:
                tiled = (held[0][0], held[1][0], 0)
                continue
            break
    if len(held[0]):
        key, part, fp = held
        if tiled and (key[0], part[0]) == tiled[:2]:
            yield out(key=int(key[0]), part=int(part[0]), fps=fp.tolist(), tile=tiled[2])
        elif pairs := groups(key, part, fp):
            yield out(pairs)


def _link_tiles(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a forest over two tiles of one key."""
    start = int(rows["key"].iloc[0]) // len(PATTERNS)
    found = list(_forest(rows["u"].to_numpy().view(np.uint64), start, _tests()))
    u, v = (np.concatenate([x[k] for x in found] or [np.empty(0, np.uint64)]).view(np.int64) for k in (0, 1))
    return pd.DataFrame({"u": u, "v": v})


def links(fps: DataFrame) -> DataFrame:
    """Links u, v that join all fingerprints within DISTANCE of each other; fps: distinct values in column fp."""
    keyed = fps.select(F.col("fp"), F.explode(chain_keys(F.col("fp"))).alias("k")).select("k.key", "k.part", "fp")
    dealt = keyed.repartition("key", "part").sortWithinPartitions("key", "part", "fp")
    found = written(dealt.mapInArrow(_link_sorted, _LINKS), "links")
    linked = found.where("tile is null").select("u", "v")
    tiles = found.where("tile is not null")
    if not tiles.isEmpty():
        counts = tiles.groupBy("key", "part").agg((F.max("tile") + 1).alias("tiles"))
        paired = tiles.join(counts, ["key", "part"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        paired = paired.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))
        linked = linked.union(paired.groupBy("key", "part", "a", "b").applyInPandas(_link_tiles, "u long, v long"))
    return linked


def _rooted(fps: DataFrame) -> DataFrame:
    """fps (a row for each distinct fp, cheap to read again) with root, one fingerprint of its component."""
    roots = written(components(links(fps.select("fp"))), "roots")
    return fps.join(roots, fps["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def classed(rows: DataFrame) -> DataFrame:
    """rows of doc_id and fingerprint with component_id, the least doc_id that links reach.

    rows must be cheap to read again. Null doc_ids never name a component; one of only such
    rows has a null id. Copies share a fingerprint and so a component. An empty table gives
    no rows.
    """
    fps = written(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "fingerprints")
    labelled = _rooted(fps)
    heads = labelled.groupBy(F.col("root").alias("head")).agg(F.min("least").alias("component_id"))
    table = labelled.join(heads, F.col("root") == F.col("head")).select("fp", "component_id")
    return rows.join(table, rows["fingerprint"] == table["fp"], "left").drop("fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row; see classed. Extra columns are left out."""
    return classed(written(fingerprinted(docs.select("doc_id", "text"), keep_text=False), "simhash"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of docs of each component: that of its least doc_id (a null one only if there is no other, the least
    fingerprint of an id that repeats, and any of rows that repeat wholly). A column fingerprint gives way."""
    # fingerprints are made once without the texts and once with them: cheaper than another copy of all texts
    id, fp = private(docs, "_id", "_fp")
    narrow = written(fingerprinted(docs.select("doc_id", "text"), keep_text=False), "simhash")
    order = [F.col("doc_id").isNull(), F.col("doc_id")]
    each = narrow.groupBy("doc_id", "fingerprint").agg(F.count(F.lit(1)).alias("copies"))
    of_print = each.groupBy(F.col("fingerprint").alias("fp")).agg(F.min_by(F.struct("doc_id", "copies"), F.struct(*order)).alias("h"))
    fps = written(of_print.select("fp", "h.doc_id", "h.copies"), "fingerprints")
    first = F.min_by(F.struct("doc_id", "fp", "copies"), F.struct(*order, F.col("fp")))
    heads = written(_rooted(fps).groupBy("root").agg(first.alias("h")).select(F.col("h.doc_id").alias(id), F.col("h.fp").alias(fp), "h.copies"), "heads")
    table = fingerprinted(docs)
    kept = table.join(heads, table["doc_id"].eqNullSafe(F.col(id)) & (table["fingerprint"] == F.col(fp)), "left_semi")
    if not heads.where("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "fingerprint"])
    return kept.drop("fingerprint")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents; nulls, texts without words, repeated rows and empty tables as in classed."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
