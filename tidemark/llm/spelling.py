"""Groups of spelling variants, by full neighbourhoods.

Of every word of the vocabulary all distinct deletions, replacements and insertions over the observed alphabet
are candidates, and those that are words themselves are its near words: candidates are joined to the
vocabulary on the string, so that no distance is computed.

A word of n letters has about 2n candidates for each letter of the alphabet, nearly all of which are
no words. They are made as hashes, in numpy from sums over the letters before and after each place, and
looked up in a bitmap of the vocabulary's hashes of a fixed size, which goes to all tasks. Only what is
found there becomes a string and is joined. The larger the vocabulary, the less the bitmap holds back; the result
is the same.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discarded, map_batches, written

#: Words have so many code points and occur so often at least.
LETTERS, OCCURRENCES = 5, 3
#: One occurrence in so many, by its crc32, loses a letter.
WORN = 97
#: A word's form occurs at least so many times as often.
OUTNUMBERS = 2
#: Distinct words that a task counts before it passes them on.
COUNTED = 200_000
#: Bits of the bitmap as a power of two (16 MB), and those looked up for a candidate.
BITS, PROBES = 27, 4
#: Candidates that a task holds at once.
CANDIDATES = 2_000_000

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of docs (doc_id, text): runs of letters in lower case, some worn by a letter, as the module's WORN says."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                if not text:
                    continue
                doc = f"{'' if (d := batch.column(0)[k].as_py()) is None else d}:"
                for run, n in Counter(_RUNS.findall(text.translate(_LOWER))).items():
                    h = zlib.crc32((doc + run).encode())
                    if not h % WORN:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LETTERS:
                        counts[run] += n
                if len(counts) >= COUNTED:
                    yield out()
        if counts:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length, as rows of code points: the powers of the base, and the sums of code times power before each place."""
    powers = np.multiply.accumulate(np.full(codes.shape[1] + 2, _BASE)) * _BACK
    before = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    np.cumsum(codes * powers[: codes.shape[1]], axis=1, out=before[:, 1:])
    return powers, before


def candidate_hashes(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """Hashes of deletions (word, place), replacements and insertions (word, place, letter)."""
    n = codes.shape[1]
    powers, before = sums(codes)
    after = before[:, -1:] - before
    yield "delete", before[:, :n] + after[:, 1:] * _BACK
    yield "replace", before[:, -1:, None] + (alphabet[None, None] - codes[:, :, None]) * powers[None, :n, None]
    yield "insert", (before + after * _BASE)[:, :, None] + alphabet[None, None] * powers[None, : n + 1, None]


def bit_of(hashes: np.ndarray, probe: int) -> np.ndarray:
    """A position in the bitmap for each hash, another one for each probe."""
    h = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * probe)
    return (h ^ (h >> np.uint64(29))) * _BASE >> np.uint64(64 - BITS)


def code_rows(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        n, end = len(words[order[at]]), at
        while end < len(order) and len(words[order[end]]) == n:
            end += 1
        yield n, order[at:end]
        at = end


def bitmap(words: DataFrame) -> np.ndarray:
    """The bitmap of words, 2 ** BITS bits, put together in blocks of 32,768 bits."""

    def step(batch: pa.RecordBatch) -> dict:
        found = batch.column("word").to_pylist()
        hashes = [sums(code_rows([found[i] for i in at]))[1][:, -1] for n, at in by_length(found) if n]
        return {"bit": np.concatenate([bit_of(h, k) for h in hashes for k in range(PROBES)]).astype(np.int64)} if hashes else None

    bits = map_batches(words.select("word"), lambda: step, "bit long")
    blocks = bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
    out = np.zeros(1 << BITS - 3, np.uint8)
    for r in blocks.collect():
        out[4096 * (r["block"] - 1) : 4096 * r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out


def may_be_words(hashes: np.ndarray, which: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Of the hashes at the places `which`, those places whose bits are all set."""
    rest = hashes.ravel()[which]
    for k in range(PROBES):
        bit = bit_of(rest, k)
        keep = np.flatnonzero(seen[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        which, rest = which[keep], rest[keep]
    return which


def neighbours(words: list[str], alphabet: np.ndarray, seen: np.ndarray) -> list[set[str]]:
    """Of words of one length: their distinct deletions, replacements and insertions, less those that the bitmap hasn't."""
    codes = code_rows(words)
    out: list[set[str]] = [set() for _ in words]
    for kind, hashes in candidate_hashes(codes, alphabet):
        every = np.flatnonzero(alphabet != codes[:, :, None]) if kind == "replace" else np.arange(hashes.size)
        for where in zip(*np.unravel_index(may_be_words(hashes, every, seen), hashes.shape), strict=True):
            word, i = words[where[0]], int(where[1])
            letter = "" if kind == "delete" else chr(int(alphabet[where[2]]))
            out[where[0]].add(word[:i] + letter + word[i + (kind != "insert") :])
    return out


def near_words(words: DataFrame) -> DataFrame:
    """word and candidate, once each: the full neighbourhood of words, less what the bitmap of words hasn't."""
    letters = [r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()]  # of 90 at most
    alphabet = np.array(sorted(map(ord, letters)), np.uint64)
    held = words.sparkSession.sparkContext.broadcast(bitmap(words))

    def step(batch: pa.RecordBatch) -> dict:
        found = batch.column("word").to_pylist()
        out: dict[str, list] = {"word": [], "candidate": []}
        for n, at in by_length(found):
            size = max(1, CANDIDATES // max(1, 2 * (n + 1) * len(alphabet)))
            for k in range(0, len(at), size):
                some = [found[i] for i in at[k : k + size]]
                for word, near in zip(some, neighbours(some, alphabet, held.value), strict=True):
                    out["word"] += [word] * len(near)
                    out["candidate"] += near
        return out

    return map_batches(words.select("word"), lambda: step, "word string, candidate string")


def roots(forms: DataFrame) -> DataFrame:
    """word and root of written forms (word, form): the last one that following forms leads to. Each round doubles the steps."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        discarded(now)
        now = further
        if now.where("went").isEmpty():
            return now.select("word", "root")


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of docs (doc_id, text).

    Null texts have no words, and a null doc_id is written as nothing before the colon; repeated rows count again; other
    columns are left out. Words without a near one have n_near 0 and no form; of near words that occur equally often the
    smallest in the order of code points is chosen. Empty tables give no rows.
    """
    words = written(word_counts(docs).where(F.col("n") >= OCCURRENCES), "words")
    near = near_words(words).join(words.select(F.col("word").alias("candidate"), F.col("n").alias("near_n")), "candidate")
    rows = near.select("word", "candidate", "near_n", F.lit(None).cast("long").alias("n")).union(words.select("word", F.lit(None), F.lit(None), "n"))
    best = F.min(F.when(F.col("candidate").isNotNull(), F.struct(-F.col("near_n"), "candidate")))
    known = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("candidate").alias("n_near"), best.alias("best"))
    chosen = F.when(-F.col("best.col1") >= OUTNUMBERS * F.col("n"), F.col("best"))
    table = written(known.select("word", "n", "n_near", chosen["candidate"].alias("form"), (-chosen["col1"]).alias("form_n")), "near_words")
    ends = roots(table.where("form is not null"))
    out = table.join(ends.withColumnRenamed("word", "_w"), F.col("word") == F.col("_w"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of documents with its near words' count, form and root."""
    return grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
