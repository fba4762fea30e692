"""Benchmark decontamination by winnowing.

Of each text's k-gram hashes, the least of every w consecutive ones is its fingerprint. Both
sides choose alike, so a shared span of w + k - 1 words or more always shares a fingerprint.
With w + k - 1 = 10, each window of 10 words has one, and windows that are equal have the same. Documents' and
items' fingerprints are joined, and a pair of them is extended to its windows, whose words
must be equal. Items of fewer than 10 words are one window, and its hash is its fingerprint.

So that only a document's likely windows are joined, a bitmap of the items' hashes, of a fixed greatest size,
goes to all tasks: each window's fingerprint and whole hash are looked up there first. The benchmark's size
changes how selective that is, but neither the result nor the number of passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import discarded, map_batches, private, written
from tidemark.llm.tokens import worker_cache

SPAN, GRAM = 10, 7
#: k-grams among which one is chosen.
CHOICE = SPAN - GRAM + 1
#: Bits of the bitmap for each window of an item, and its least and greatest size as powers of two (16 MB at most).
BITS_A_WINDOW, LEAST_BITS, MOST_BITS = 64, 16, 27
#: Windows of items are broadcast if there are at most so many, else joined by shuffles of salted keys.
BROADCAST_WINDOWS, SALTS = 100_000, 16
#: Texts with hits are broadcast if there are at most so many.
BROADCAST_TEXTS = 500_000
#: Words whose hashes a worker remembers.
HELD = 200_000

#: A-Z to a-z; other ASCII characters but digits and a-z to spaces; bytes of other characters stay.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, SPAN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SPANS = "array<struct<begin:int,end:int>>"
_WINDOW = "size int, print long, start int, window string"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class WordHashes(dict):
    """64-bit hashes of words; remembers up to HELD."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    """The process's own, over tasks."""
    return worker_cache().setdefault("word_hashes", WordHashes())


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive words' hashes."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    h = np.full(size, n, np.uint64)
    for k in range(n):
        h += words[k : k + size] * _FACTORS[k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def winnowed(hashes: np.ndarray, choice: int = CHOICE) -> np.ndarray:
    """For every `choice` consecutive hashes, the position of the least (the last of equal ones)."""
    if len(hashes) < choice:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, choice)[:, ::-1]
    return np.arange(len(windows)) + choice - 1 - np.argmin(windows, axis=1)


def fingerprints(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of so many words: its fingerprint, and the hash of all its words."""
    whole = gram_hashes(words, size)
    if size < SPAN:
        return whole, whole
    grams = gram_hashes(words, GRAM)
    return grams[winnowed(grams)], whole


def item_windows(items: DataFrame) -> DataFrame:
    """Distinct windows of items (item_id, text): size, print, whole, window, item (its id as a string; maybe null)."""

    def make():
        hashes = word_hashes()

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("size", "print", "whole", "window", "item")}
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                size = min(SPAN, len(words))
                if size:
                    prints, whole = fingerprints(hashes.of(words), size)
                    out["print"] += prints.view(np.int64).tolist()
                    out["whole"] += whole.view(np.int64).tolist()
                    out["window"] += [b" ".join(words[k : k + size]).decode() for k in range(len(whole))]
                    out["size"] += [size] * len(whole)
                    out["item"] += [item] * len(whole)
            return out

        return step

    named = items.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("text").isNotNull())
    return map_batches(named, make, "size int, print long, whole long, window string, item string").distinct()


class Bitmap:
    """The hashes that may be there: bit h >> (64 - bits) is set for each that is."""

    def __init__(self, bits: int, data: np.ndarray) -> None:
        self.shift, self.data = np.uint64(64 - bits), data

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(windows: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """Bits and bytes of the bitmap of n windows' fingerprints and whole hashes."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(n * BITS_A_WINDOW).bit_length()))
    part = LEAST_BITS - 3  # bytes of a part, as a power of two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            for k in np.unique(at >> (part + 3)).tolist():
                own = parts.setdefault(k, np.zeros(1 << part, np.uint8))
                here = at[at >> (part + 3) == k] & ((1 << (part + 3)) - 1)
                np.bitwise_or.at(own, here >> 3, np.left_shift(1, here & 7).astype(np.uint8))
        for k, own in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([own.tobytes()], pa.binary())], names=["part", "data"])

    at = windows.select(F.explode(F.array("print", "whole")).alias("h")).select(F.shiftrightunsigned("h", 64 - bits).alias("at")).distinct()
    dealt = at.repartition(F.shiftright("at", part + 3))  # so that a part is made by one task
    data = np.zeros(1 << (bits - 3), np.uint8)
    for r in dealt.mapInArrow(run, "part long, data binary").toLocalIterator():
        data[r["part"] << part : (r["part"] + 1) << part] |= np.frombuffer(r["data"], np.uint8)
    return bits, data


RESULTS = ("n_words", "hit_spans", "hit_items")


def candidates(docs: DataFrame, keep: list[str], sizes: list[int], bits: int, data: np.ndarray, likely: str) -> DataFrame:
    """The columns keep of docs with n_words and, in the column likely, the windows that the bitmap may hold."""
    shipped = docs.sparkSession.sparkContext.broadcast((bits, data))

    def make():
        hashes, known = word_hashes(), Bitmap(*shipped.value)

        def likely_in(words: list[bytes]) -> list[dict]:
            own, out = hashes.of(words), []
            for size in sizes:
                if len(words) < size:
                    continue
                prints, whole = fingerprints(own, size)
                at = np.flatnonzero(known.may_hold(prints))
                at = at[known.may_hold(whole[at])]
                signed = prints.view(np.int64)
                out += [{"size": size, "print": int(signed[k]), "start": k, "window": b" ".join(words[k : k + size]).decode()} for k in at.tolist()]
            return out

        def step(batch: pa.RecordBatch) -> dict:
            counts, found = [], []
            for text in batch.column("text"):  # one text's words at a time
                words = words_of(text.as_py())
                counts.append(len(words))
                found.append(likely_in(words))
            return {c: batch.column(c) for c in keep} | {"n_words": counts, likely: found}

        return step

    fields = ",".join(f"{name}:{kind}" for name, kind in (x.split() for x in _WINDOW.split(", ")))
    schema = StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL(f"n_words long, `{likely}` array<struct<{fields}>>")])
    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


class Benchmark:
    """What documents are joined with: the items' windows as a table, and their bitmap."""

    def __init__(self, benchmark: DataFrame) -> None:
        self.windows = written(item_windows(benchmark), "item_windows")
        self.n = self.windows.count()
        self.sizes = sorted(r["size"] for r in self.windows.select("size").distinct().collect())  # SPAN at most
        self.bits, self.data = bitmap_of(self.windows, self.n)

    def hits(self, found: DataFrame) -> DataFrame:
        """Of rows of row (any key) and of the columns of _WINDOW: those whose fingerprint and words an item has, with item."""
        table = self.windows.select("size", "print", "window", "item")
        if self.n <= BROADCAST_WINDOWS:
            return found.join(F.broadcast(table), ["size", "print", "window"])
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return found.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int")).join(salted, ["size", "print", "window", "salt"]).drop("salt")


def spans_of(hits: DataFrame) -> DataFrame:
    """row and hit_spans (merged, in order) of rows of row, start and size."""
    by_start = Window.partitionBy("row").orderBy("begin", "end")
    each = hits.select("row", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end")).distinct()
    reached = each.withColumn("reached", F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    numbered = reached.withColumn("run", F.sum(F.when(F.col("begin") <= F.col("reached"), 0).otherwise(1)).over(by_start))
    runs = numbered.groupBy("row", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("hit_spans"))  # a text's own


def scanned(docs: DataFrame, benchmark: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with n_words, hit_spans (of words, end exclusive) and hit_items (ids as strings, sorted); read once.

    A null text has no words. An item without words hits nothing; one whose id is null hits
    words but isn't named, and one whose id is empty is; equal items are all named, equal rows have equal
    results. An empty benchmark hits nothing, an empty table gives no rows. Columns of docs named as the results
    give way; other extra columns stay.
    """
    docs = docs.drop(*RESULTS)
    own_row, likely, own_key = private(docs, "_row", "_likely", "_key")
    keep = [c for c in docs.columns if keep_text or c != "text"]
    own = Benchmark(benchmark)
    table = written(candidates(docs, keep, own.sizes, own.bits, own.data, likely).withColumn(own_row, F.monotonically_increasing_id()), "scanned")
    hits = written(own.hits(table.select(F.col(own_row).alias("row"), F.explode(likely).alias("x")).select("row", "x.*")), "hits")
    items = hits.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("hit_items"))
    found = spans_of(hits).join(items, "row").withColumnRenamed("row", own_key)
    joined = table.join(found, F.col(own_row) == F.col(own_key), "left")
    none = {"hit_spans": F.array().cast(_SPANS), "hit_items": F.array().cast("array<string>")}
    return joined.select(*keep, "n_words", *(F.coalesce(c, x).alias(c) for c, x in none.items()))


def hit_words() -> Column:
    """The number of hit words, of the column hit_spans."""
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a hit word, null and empty texts among them; equal rows all stay or all go. Nulls and
    clashes as in scanned. Texts are not written again: those with hits are known by two hashes."""
    first, second = private(docs, "_hash", "_hash2")
    keyed = docs.withColumns({first: F.xxhash64("text"), second: F.xxhash64(F.lit(2), "text")})
    own = Benchmark(benchmark)
    narrow = candidates(keyed.select("text", first, second), [first, second], own.sizes, own.bits, own.data, "likely").where(F.size("likely") > 0)
    found = written(narrow.select(F.struct(first, second).alias("row"), F.explode("likely").alias("x")).select("row", "x.*"), "likely")
    hits = written(own.hits(found).select("row").distinct(), "hit_texts")
    texts = hits.select(F.col(f"row.{first}").alias(first), F.col(f"row.{second}").alias(second))
    if hits.count() <= BROADCAST_TEXTS:
        texts = F.broadcast(texts)
    discarded(found)
    return keyed.join(texts, [first, second], "left_anti").select(*docs.columns)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of scanned; nulls, repeats and empty tables as there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scanned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_text=False)
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (hit_words() > 0).alias("contaminated"),
    )
