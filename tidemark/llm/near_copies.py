"""Near copies by shingles: a wide SimHash with candidates from chains on a ring, and the shingles themselves as judge.

A text's distinct 5-word shingles give 1,024 bits. Two sets of Jaccard similarity J differ in about
arccos(2 J / (1 + J)) / pi of them: 155 bits at 0.8, with a deviation of 11.5. Texts are linked if their similarity is
SIMILARITY or more. Pairs that differ in more than FAR bits, two and a half deviations over that, are not looked at. Those
of SURE bits at most, five deviations under it, are linked as they are. Between these the shingles of both are compared,
unless both are linked by others already.

The bits lie on a ring. A key is a run of consecutive bits; its width grows with the logarithm of the number of
texts, so that strangers seldom share one, and there are KEYS of them. From where a shared key starts, the ring is cut into SEGMENTS, and the first chain
is held to its proportional budget, FAR / SEGMENTS bits (pigeonring filtering); what passes meets the whole ring's. Longer chains
aren't tested in between: they would need more bits in each key's row. Of SMALL texts or fewer that share a key all pairs of close
first chains are candidates. Of more, only a spanning forest by the first chain is, each key giving another. That is done within each batch already, so that a large group of copies is small before any shuffle.

All this finds most links and joins large groups early. Those that it misses are between two of its groups, and `completed` finds every
one of them by an exact join of shingles on prefixes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm import prefixes
from tidemark.llm.common import discarded, map_batches, private, written
from tidemark.llm.decontamination import word_hashes
from tidemark.llm.graph import components

SHINGLE, BITS, SIMILARITY = 5, 1024, 0.8
SEGMENTS = 8
#: The share of bits that differ at SIMILARITY; bits up to which and over which shingles needn't be compared.
DIFFERING = math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
_DEVIATION = math.sqrt(BITS * DIFFERING * (1 - DIFFERING))
SURE, FAR = int(BITS * DIFFERING - 5 * _DEVIATION), int(BITS * DIFFERING + 2.5 * _DEVIATION)
#: Keys of a text, however many texts there are: a pair at SIMILARITY shares about two of them among 40,000 texts, a closer one more. Of pairs that share none, the exact join finds all.
KEYS = 32
#: Texts that share a key of which all pairs are candidates: over all, and of those of one batch, where more show a large group.
SMALL, SMALL_IN_BATCH = 16, 4
LEAST_WIDTH, MOST_WIDTH = 16, 60
#: Rows to drop are broadcast if there are at most so many.
BROADCAST_ROWS = 500_000

_WORDS = BITS // 64
_STEPS = (np.arange(1, _WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
_ODD = np.random.default_rng(5).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles_of(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles of the whole text, A-Z in lower case; of fewer words, that of all; of none, none."""
    words = word_hashes().of((text or "").encode().lower().split())
    n = min(SHINGLE, len(words))
    h = np.full(len(words) - n + 1 if n else 0, n, np.uint64)
    for k in range(n):
        h += words[k : k + len(h)] * _ODD[k]
    return np.unique(h)


def bit_counts(x: np.ndarray) -> np.ndarray:
    """How often each bit is set over rows of words, by carry-save addition: three rows of a weight become one, and one
    of twice the weight."""
    counts, weight = np.zeros(BITS, np.int64), 1
    while len(x):
        carried = []
        while len(x) > 2:
            m = len(x) // 3
            a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
            u = a ^ b
            carried.append((a & b) | (c & u))
            x = np.concatenate((u ^ c, x[3 * m :]))
        counts += weight * np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        x, weight = np.concatenate(carried) if carried else x[:0], 2 * weight
    return counts


def wide_fingerprint(text: str | None) -> bytes:
    """BITS bits of the whole text, each set if it is in over half of the shingles' hashes; zeros without words."""
    shingles = shingles_of(text)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(shingles), 8192):  # bounded, however long the text
        h = shingles[k : k + 8192, None] + _STEPS
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        counts += bit_counts(h)
    return np.packbits(2 * counts > len(shingles), bitorder="little").tobytes()


def key_plan(texts: int) -> tuple[int, np.ndarray]:
    """The width of keys for so many texts, and where on the ring they start."""
    width = min(MOST_WIDTH, max(LEAST_WIDTH, math.ceil(math.log2(max(2, texts))) + 1))
    return width, (np.arange(KEYS) * BITS // KEYS).astype(np.int64)


def run_of_bits(bits: np.ndarray, start: int, width: int) -> np.ndarray:
    """Of each row of the ring's words, width bits (64 at most) from start on."""
    word, off = divmod(start, 64)
    x = bits[:, word] >> np.uint64(off)
    if off:
        x = x | (bits[:, (word + 1) % _WORDS] << np.uint64(64 - off))
    return x & np.uint64((1 << width) - 1) if width < 64 else x


def first_chain(bits: np.ndarray, start: int) -> np.ndarray:
    """The chain of one segment from start on, in two words."""
    half = BITS // SEGMENTS // 2
    return np.stack([run_of_bits(bits, start, half), run_of_bits(bits, (start + half) % BITS, half)], axis=1)


def _close(chains: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.bitwise_count(chains ^ x).sum(axis=1) <= FAR // SEGMENTS)


def forest(nodes: np.ndarray, chains: np.ndarray, small: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of nodes whose first chains are close, and the places of those that stand for all: all pairs of a few nodes, else
    the edges of a spanning forest, whose roots stand for it."""
    if len(nodes) <= small:
        near = np.bitwise_count(chains[:, None] ^ chains[None]).sum(axis=2) <= FAR // SEGMENTS
        x, y = np.nonzero(np.triu(near, 1))
        return list(zip(nodes[x].tolist(), nodes[y].tolist(), strict=True)), np.arange(len(nodes))
    edges: list[tuple[int, int]] = []
    roots, rest = [], np.arange(len(nodes))
    while len(rest):
        roots.append(rest[0])
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            at = _close(chains[rest], chains[x])
            if len(at):
                found = rest[at]
                edges += [(int(nodes[x]), int(nodes[y])) for y in found]
                front.extend(found)
                rest = np.delete(rest, at)
    return edges, np.array(roots, np.int64)


_KEYED = "u long, v long, key int, part long, a long, b long"
#: The key of rows that are edges.
EDGE = -1


def _out(edges: list[tuple[int, int]], rows: tuple[np.ndarray, ...] | None = None) -> pa.RecordBatch:
    """Rows of a node (as u), key, part and first chain; of an edge u, v, whose key is EDGE and whose part spreads it."""
    rows = rows or tuple(np.empty(0, np.int64) for _ in range(5))
    u, v = np.array(edges, np.int64).reshape(-1, 2).T
    none = np.zeros(len(u), np.int64)
    columns = [np.concatenate(x) for x in ((u, rows[0]), (v, np.zeros(len(rows[0]), np.int64)), (none + EDGE, rows[1]), (u ^ v, rows[2]), (none, rows[3]), (none, rows[4]))]
    return pa.RecordBatch.from_arrays([pa.array(x).cast(t) for x, t in zip(columns, (*[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 3), strict=True)], names=["u", "v", "key", "part", "a", "b"])


def keyed(prints: DataFrame, texts: int) -> DataFrame:
    """Edges within batches of prints (node, bits), and what is left of each key: see _KEYED."""
    width, starts = key_plan(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 8192):
                rows = batch.slice(k, 8192)
                node = rows.column("node").to_numpy()
                bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), np.uint64).reshape(len(node), _WORDS)
                seen: set[tuple[int, int]] = set()
                for key, start in enumerate(starts.tolist()):
                    part, chains = run_of_bits(bits, start, width), first_chain(bits, start)
                    order = np.argsort(part, kind="stable")
                    edge = np.flatnonzero(np.diff(part[order], prepend=part[order[:1]] ^ np.uint64(1)))
                    sizes, left = np.diff(np.append(edge, len(order))), [order[edge]]
                    for g in np.flatnonzero(sizes > 1).tolist():
                        own = order[edge[g] : edge[g] + sizes[g]]
                        found, roots = forest(node[own], chains[own], SMALL_IN_BATCH)
                        seen.update(found)
                        left.append(own[roots[1:]])  # the first one stands for its key already
                    own = np.concatenate(left)
                    yield _out([], (node[own], np.full(len(own), key, np.int64), part[own].view(np.int64), chains[own, 0].view(np.int64), chains[own, 1].view(np.int64)))
                yield _out(list(seen))

    return prints.select("node", "bits").mapInArrow(run, _KEYED)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges u, v of rows sorted by key and part. Of a key that goes over many batches, only what forest keeps is carried on."""
    held = tuple(np.empty(0, np.int64) for _ in range(5))
    for batch in batches:
        batch_edges = pc.equal(batch.column("key"), EDGE)
        yield batch.filter(batch_edges).select(["u", "v"])
        batch = batch.filter(pc.invert(batch_edges))
        rows = tuple(batch.column(c).to_numpy().astype(np.int64) for c in ("u", "key", "part", "a", "b"))
        node, key, part, a, b = (np.concatenate(x) for x in zip(held, rows, strict=True))
        if not len(node):
            continue
        first = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1))
        sizes, chains = np.diff(np.append(first, len(node))), np.stack([a, b], axis=1).view(np.uint64)
        edges, carried = [], np.arange(first[-1], len(node))
        for g in np.flatnonzero(sizes > 1).tolist():
            own = np.arange(first[g], first[g] + sizes[g])
            found, roots = forest(node[own], chains[own], SMALL)
            edges += found
            if g == len(first) - 1:
                carried = own[roots]
        held = tuple(x[carried] for x in (node, key, part, a, b))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.array(edges, np.int64).T], names=["u", "v"])


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits two rings' words differ, by row."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def candidates(prints: DataFrame, texts: int) -> DataFrame:
    """Pairs u, v of nodes of prints (node, bits; a written table) that share a key and differ in FAR bits at most, and how many they differ in."""
    dealt = keyed(prints, texts).repartition("key", "part").sortWithinPartitions("key", "part", "u")
    edges = dealt.mapInArrow(_joined, "u long, v long")
    pairs = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    x, y = prints.select(F.col("node").alias("u"), F.col("bits").alias("x")), prints.select(F.col("node").alias("v"), F.col("bits").alias("y"))

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            d = differing(*(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, _WORDS) for c in ("x", "y")))
            at = np.flatnonzero(d <= FAR)
            return {c: batch.column(c).take(pa.array(at)) for c in ("u", "v")} | {"d": d[at]}

        return step

    return written(map_batches(pairs.join(x, "u").join(y, "v"), make, "u long, v long, d int"), "ring_pairs")


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs u, v whose texts (node, text) have a Jaccard similarity of SIMILARITY or more."""

    def shingled():
        return lambda batch: {"node": batch.column("node"), "shingles": [shingles_of(x.as_py()).tobytes() for x in batch.column("text")]}

    def judged():
        def step(batch: pa.RecordBatch) -> dict:
            keep = []
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if shared >= SIMILARITY * (len(a) + len(b) - shared) - 1e-9:
                    keep.append(k)
            return {c: batch.column(c).take(pa.array(keep, pa.int64())) for c in ("u", "v")}

        return step

    sets = map_batches(texts, shingled, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
    x, y = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x")), sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    return map_batches(pairs.select("u", "v").join(x, "u").join(y, "v"), judged, "u long, v long")


def fingerprinted(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The columns keys of docs, and bits."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {c: batch.column(c) for c in keys} | {"bits": [wide_fingerprint(x.as_py()) for x in batch.column("text")]}

        return step

    return map_batches(docs.select("text", *keys), make, StructType([*(docs.schema[c] for c in keys), *StructType.fromDDL("bits binary")]))


def grouped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct bits of rows (h, h2, bits; a written table), with node and root, one node of all that links reach. docs has the texts, by h and h2."""
    prints = written(rows.select("bits").distinct().withColumn("node", F.monotonically_increasing_id()), "prints")
    pairs = candidates(prints, prints.count())
    sure = written(components(pairs.where(F.col("d") <= SURE)), "sure_roots")
    apart = pairs.where(F.col("d") > SURE).select("u", "v")
    for c in ("u", "v"):
        apart = apart.join(sure.select(F.col("node").alias("of"), F.col("root").alias(f"root_{c}")), F.col(c) == F.col("of"), "left").drop("of").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    apart = written(apart.where("root_u <> root_v"), "pairs_apart")
    nodes = apart.select(F.col("u").alias("node")).union(apart.select("v")).distinct()
    wanted = rows.groupBy("bits").agg(F.min(F.struct("h", "h2")).alias("of")).join(prints.join(nodes, "node"), "bits").select("node", F.col("of.h").alias("_h"), F.col("of.h2").alias("_h2"))
    wanted = written(wanted, "wanted_texts")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.join(few, (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2"))).select("node", "text")
    tied = written(similar(apart, texts), "ring_links").join(apart, ["u", "v"]).select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))
    joined = written(components(tied), "ring_roots")
    first = prints.join(sure.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("bits", "node", F.coalesce("root", "node").alias("near"))
    found = written(first.join(joined.withColumnRenamed("node", "of"), F.col("near") == F.col("of"), "left").select("bits", "node", F.coalesce("root", "near").alias("root")), "groups")
    discarded(prints, pairs, sure, apart, wanted, joined)
    return completed(rows, docs, found)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of wanted (_h, node; a written table)."""
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return docs.join(few, F.col("h") == F.col("_h")).select("node", "text")


def completed(rows: DataFrame, docs: DataFrame, found: DataFrame) -> DataFrame:
    """Groups found, joined by all links between them that the fingerprints missed: the exact join looks at every pair of texts of two groups."""
    roots = written(rows.select("h", "bits").distinct().join(found.select("bits", "root"), "bits").groupBy("h").agg(F.min("root").alias("root")), "roots_of_texts")
    pairs = prefixes.candidates(docs.select("h", "text"), roots, shingles_of, SIMILARITY, roots.count())
    wanted = written(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().withColumn("_h", F.col("node")), "wanted_texts")
    links = written(similar(pairs, texts_of(docs, wanted)), "prefix_links")
    for c in ("u", "v"):
        links = links.join(roots.select(F.col("h").alias(c), F.col("root").alias(f"root_{c}")), c)
    joined = written(components(links.select(F.col("root_u").alias("u"), F.col("root_v").alias("v"))), "joined_roots")
    whole = found.withColumnRenamed("root", "near").join(joined.withColumnRenamed("node", "of"), F.col("near") == F.col("of"), "left")
    whole = written(whole.select("bits", "node", F.coalesce("root", "near").alias("root")), "groups")
    discarded(found, roots, pairs, wanted, joined)
    return whole


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of docs of each group of near copies: that of its least doc_id (a null one only if there is no other; of an
    id that repeats, the text of the least hash; of rows whose id and text repeat, any one).

    Null texts and texts without words are one group. An empty table gives no rows; extra columns stay. Texts are
    not written again: rows to drop are known by doc_id and two hashes of their text.
    """
    first, second = private(docs, "_hash", "_hash2")
    keyed_docs = docs.withColumns({first: F.xxhash64("text"), second: F.xxhash64(F.lit(2), "text")})
    plain = keyed_docs.select("doc_id", "text", F.col(first).alias("h"), F.col(second).alias("h2"))
    rows = written(fingerprinted(plain, ["doc_id", "h", "h2"]), "wide_simhash")
    table = grouped(rows, plain.select("h", "h2", "text"))
    each = rows.groupBy("doc_id", "h", "h2", "bits").agg(F.count(F.lit(1)).alias("copies"))
    each = written(each.join(table.select("bits", "root"), "bits").drop("bits"), "members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h", "h2")
    heads = each.groupBy(F.col("root").alias("of")).agg(F.min(order).alias("head"))
    marked = each.join(heads, F.col("root") == F.col("of"))
    gone = written(marked.where(order != F.col("head")).select(F.col("doc_id").alias("id"), F.col("h").alias(first), F.col("h2").alias(second)), "near_copies")
    many = gone.count() > BROADCAST_ROWS
    repeated = not each.where("copies > 1").isEmpty()
    same = keyed_docs["doc_id"].eqNullSafe(gone["id"]) & (keyed_docs[first] == gone[first]) & (keyed_docs[second] == gone[second])
    kept = keyed_docs.join(gone if many else F.broadcast(gone), same, "left_anti")
    return (kept.dropDuplicates(["doc_id", first, second]) if repeated else kept).select(*docs.columns)
