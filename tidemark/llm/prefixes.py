"""All pairs of sets that may reach a Jaccard similarity, by prefixes: none is left out.

In one order of all elements, two sets of similarity t or more share an element among the first n - ceil(t n) + 1 of each,
n being its size (prefix filtering). Any order is exact; elements that many sets have stand last in this one, so that
few sets share one of a prefix. The commonest are learned from a sample of bounded size, which decides the cost and nothing else.

Sets come with a root, and pairs of one root are not asked for: they are linked already. So a large group of copies, once
joined by other means, makes no pairs. Of the rest, sizes and places in the order bound what two sets can share, and sketches how many elements they differ in: a
pair is made once its rows are known to be of two roots and near by all of these. So strangers that share an element by chance, whose
number grows with the square of the corpus, are compared in place and make no rows. An element that many sets
of several roots have in their prefixes is dealt in tiles, and every pair of tiles is compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discarded, map_batches, written

#: Sets of the sample, how many of them have an element that is common, and common elements there are at most.
SAMPLE, MANY, MOST_COMMON = 20_000, 8, 200_000
#: Sets that share an element of which partners are looked for before sketches are known; of more, those compared by one group.
FEW, TILE = 16, 16_384
#: Bits of a sketch: two to four an element between these.
LEAST_BITS, MOST_BITS = 256, 4096
#: Texts to sketch are broadcast by their hashes if there are at most so many.
BROADCAST_ROWS = 500_000
#: Sets or pairs that a task remembers, so that copies are taken once by it.
REMEMBERED = 50_000
#: What rounding may cost.
SLACK = 1e-6

Elements = Callable[[str | None], np.ndarray]


def common_elements(texts: DataFrame, elements: Elements, count: int) -> np.ndarray:
    """The commonest elements of SAMPLE of count texts (h, text), those of the least hashes; the commonest last."""
    share = min(1.0, SAMPLE / max(1, count))

    def make():
        return lambda batch: {"element": np.concatenate([np.empty(0, np.uint64), *(elements(x.as_py()) for x in batch.column("text"))]).view(np.int64)}

    sample = texts.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))
    counts = map_batches(sample.select("text"), make, "element long").groupBy("element").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MANY)
    most = counts.orderBy(F.desc("n"), "element").limit(MOST_COMMON).collect()
    return np.array([r["element"] for r in reversed(most)], np.int64).view(np.uint64)


def prefix(own: np.ndarray, common: np.ndarray, rank: np.ndarray, least: float) -> np.ndarray:
    """The first of own distinct elements, of which a set of similarity least must have one: rare ones in order, then common ones by rank."""
    at = np.minimum(np.searchsorted(common, own), max(0, len(common) - 1))
    known = common[at] == own if len(common) else np.zeros(len(own), bool)
    late = own[known][np.argsort(rank[at[known]])] if known.any() else own[:0]
    return np.concatenate((np.sort(own[~known]), late))[: len(own) - math.ceil(least * len(own) - SLACK) + 1 if len(own) else 0]


def prefix_rows(texts: DataFrame, elements: Elements, common: np.ndarray, least: float) -> DataFrame:
    """element, h and at (size and place, in one number) of the prefix of each of texts (h, text); copies are taken once a task."""
    order = np.argsort(common)
    ordered, rank = common[order], order

    def make():
        seen: set[int] = set()

        def step(batch: pa.RecordBatch) -> dict:
            found, sizes, ids = [np.empty(0, np.uint64)], [], []
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text"), strict=True):
                if h in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(h)
                own = elements(text.as_py())
                found.append(prefix(own, ordered, rank, least))
                sizes.append(len(own))
                ids.append(h)
            lengths = np.array([len(x) for x in found[1:]], np.int64)
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            return {"element": np.concatenate(found).view(np.int64), "h": np.repeat(np.array(ids, np.int64), lengths), "at": np.repeat(np.array(sizes, np.int64), lengths) << 32 | place}

        return step

    return map_batches(texts.select("h", "text"), make, "element long, h long, at long")


_ROW = ("element", "at", "h")
_ROOTED = (*_ROW, "root")


def _batch(columns: tuple[np.ndarray, ...], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=list(names))


def _groups(element: np.ndarray) -> np.ndarray:
    """Where groups of sorted elements start."""
    return np.flatnonzero(np.concatenate(([True], element[1:] != element[:-1])))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by element, at and h, copies once: those whose element several sets have."""
    held, passed = tuple(np.empty(0, np.int64) for _ in _ROW), False  # the last row, and whether it was passed on already
    for batch in batches:
        rows = tuple(np.concatenate((x, batch.column(c).to_numpy())) for x, c in zip(held, _ROW, strict=True))
        if not len(rows[0]):
            continue
        new = np.ones(len(rows[0]), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in rows], axis=0)
        rows = tuple(x[new] for x in rows)
        same = rows[0][1:] == rows[0][:-1]
        several = np.concatenate((same, [False])) | np.concatenate(([False], same))
        was = len(rows[0]) == 1 and passed
        several[0] &= not passed
        yield _batch(tuple(x[several] for x in rows), _ROW)
        held, passed = tuple(x[-1:] for x in rows), bool(several[-1]) or was
    pa.default_memory_pool().release_unused()


def _partnered(least: float):
    """Of rows sorted by element, at and h: of an element that FEW sets at most have, those that may pair with one of another root; of one that more have, all."""

    def partners(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        element, at, _, root = rows
        keep = np.zeros(len(element), bool)
        for x, y in pairs_of(element, at, least):
            apart = root[x] != root[y]
            keep[x[apart]] = keep[y[apart]] = True
        return _batch(tuple(x[keep] for x in rows), _ROOTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # held: the last group's rows, or the last of them alone if more than FEW were passed on already
        held, passed = tuple(np.empty(0, np.int64) for _ in _ROOTED), False
        for batch in batches:
            rows = tuple(np.concatenate((x, batch.column(c).to_numpy())) for x, c in zip(held, _ROOTED, strict=True))
            if not len(rows[0]):
                continue
            starts = _groups(rows[0])
            sizes = np.diff(np.append(starts, len(rows[0])))
            many = sizes > FEW
            many[0] |= passed
            large = np.repeat(many, sizes)
            fresh = large.copy()
            fresh[0] &= not passed
            yield _batch(tuple(x[fresh] for x in rows), _ROOTED)
            last = starts[-1]
            yield partners(tuple(x[:last][~large[:last]] for x in rows))
            passed = bool(many[-1])
            held = tuple(x[-1:] if passed else x[last:] for x in rows)
        if not passed:
            yield partners(held)
        pa.default_memory_pool().release_unused()

    return run


def sketch(own: np.ndarray) -> bytes:
    """Of each of a power of two of bits, whether an odd number of own elements falls on it: two sets differ in as many elements, at
    least, as their sketches in bits. Half of a sketch's words, XORed with the other half, are the sketch of half the bits."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(own)).bit_length()))
    at = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


class _Sketches:
    """Sketches of rows, of several lengths."""

    def __init__(self, sketches: pa.Array) -> None:
        self.words = np.array([len(x) // 8 for x in sketches.to_pylist()], np.int64) if len(sketches) else np.empty(0, np.int64)
        self.rows, self.place = {}, {}
        own = {w: np.flatnonzero(self.words == w) for w in np.unique(self.words).tolist()}
        whole = {w: np.frombuffer(b"".join(sketches.take(pa.array(at)).to_pylist()), np.uint64).reshape(-1, w) for w, at in own.items()}
        for w, at in own.items():
            parts, places = [whole[w]], [at]
            if 2 * w in own:
                parts.append(whole[2 * w][:, :w] ^ whole[2 * w][:, w:])
                places.append(own[2 * w])
            self.rows[w], self.place[w] = np.concatenate(parts), np.zeros(len(self.words), np.int64)
            self.place[w][np.concatenate(places)] = np.arange(len(self.rows[w]))

    def differing(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many bits the rows x and y differ. Their lengths may be one power of two apart."""
        out, words = np.zeros(len(x), np.int64), np.minimum(self.words[x], self.words[y])
        for w in np.unique(words).tolist():
            at = np.flatnonzero(words == w)
            rows, place = self.rows[w], self.place[w]
            out[at] = np.bitwise_count(rows[place[x[at]]] ^ rows[place[y[at]]]).sum(axis=1, dtype=np.int64)
        return out


_TILED = ("element", "a", "b", "at", "own", "h", "root")


def pairs_of(group: np.ndarray, at: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, each group's sorted by at, which sizes and places don't rule out."""
    size, left = at >> 32, (at >> 32) - (at & 0xFFFFFFFF)  # left: elements from this place on
    x, apart = np.arange(len(at)), 0
    while len(x):
        apart += 1
        x = x[x + apart < len(at)]
        within = (group[x] == group[x + apart]) & (size[x + apart] * least <= size[x] + SLACK)  # sizes grow within a group
        x = x[within]
        y = x + apart
        may = np.minimum(left[x], left[y]) >= least / (1 + least) * (size[x] + size[y]) - SLACK
        if may.any():
            yield x[may], y[may]


def _paired(least: float):
    """Pairs u, v of two roots of rows sorted by element, tiles and at, whose sketches don't rule them out. The last group is held until its end is seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()

        def out(rows: tuple[np.ndarray, ...], sketches: pa.Array) -> Iterator[pa.RecordBatch]:
            element, a, b, at, own, h, root = rows
            new = np.concatenate(([False], (element[1:] != element[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(element)]
            of, size = _Sketches(sketches), at >> 32
            for x, y in pairs_of(np.cumsum(new), at, least):
                apart = (root[x] != root[y]) & ((a[x] == b[x]) | (own[x] != own[y]))
                x, y = x[apart], y[apart]
                near = of.differing(x, y) <= (1 - least) / (1 + least) * (size[x] + size[y]) + SLACK
                x, y = h[x[near]], h[y[near]]
                pairs = set(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True)) - known
                if len(known) < REMEMBERED:
                    known.update(pairs)
                if pairs:
                    yield _batch(tuple(np.array(list(pairs), np.int64).T), ("u", "v"))

        held, sketches = tuple(np.empty(0, np.int64) for _ in _TILED), pa.array([], pa.binary())
        for batch in batches:
            rows = tuple(np.concatenate((x, batch.column(c).to_numpy())) for x, c in zip(held, _TILED, strict=True))
            sketches = pa.concat_arrays([sketches, batch.column("sketch").cast(pa.binary())])
            ends = np.flatnonzero(np.any([x[1:] != x[:-1] for x in rows[:3]], axis=0))
            last = ends[-1] + 1 if len(ends) else 0
            yield from out(tuple(x[:last] for x in rows), sketches[:last])
            held, sketches = tuple(x[last:] for x in rows), sketches[last:]
        yield from out(held, sketches)
        pa.default_memory_pool().release_unused()

    return run


def sketches_of(texts: DataFrame, wanted: DataFrame, elements: Elements) -> DataFrame:
    """h and sketch of the texts (h, text) that are wanted (h, distinct; a written table)."""

    def make():
        return lambda batch: {"h": batch.column("h"), "sketch": [sketch(elements(x.as_py())) for x in batch.column("text")]}

    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return map_batches(texts.join(few, "h").select("h", "text"), make, "h long, sketch binary").groupBy("h").agg(F.first("sketch").alias("sketch"))


def candidates(texts: DataFrame, roots: DataFrame, elements: Elements, least: float, count: int) -> DataFrame:
    """Pairs u, v (u < v) of h of two roots (h, root: one a text) that hold all such pairs whose similarity is least or more, as a written table. count: texts, about."""
    common = common_elements(texts, elements, count)
    dealt = prefix_rows(texts, elements, common, least).repartition("element").sortWithinPartitions(*_ROW)
    shared = written(dealt.mapInArrow(_shared, "element long, at long, h long"), "shared_elements")
    dealt = shared.join(roots, "h").select(*_ROOTED).repartition("element").sortWithinPartitions(*_ROW)
    rows = written(dealt.mapInArrow(_partnered(least), "element long, at long, h long, root long"), "partnered_rows")
    mixed = rows.groupBy("element").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    tiled = rows.join(mixed.select("element", F.ceil(F.col("n") / TILE).alias("tiles")), "element").withColumn("own", F.pmod(F.xxhash64("h"), F.col("tiles")))
    tiled = written(tiled, "tiled_rows")
    wanted = written(tiled.select("h").distinct(), "texts_to_sketch")
    whole = tiled.join(sketches_of(texts, wanted, elements), "h").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    whole = whole.select("element", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "at", "own", "h", "root", "sketch")
    near = whole.repartition("element", "a", "b").sortWithinPartitions("element", "a", "b", "at").mapInArrow(_paired(least), "u long, v long")
    pairs = written(near.distinct(), "prefix_pairs")
    discarded(shared, rows, tiled, wanted)
    return pairs
