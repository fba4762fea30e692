"""The language of texts by ranks of letter trigrams.

A language's profile is its commonest trigrams in order, learned from labelled texts; a text's own profile is held
against each of them. A trigram costs the distance of its two ranks, and one that a language lacks the most
there is; the language of the least total is the text's. Trigrams are those of words in lower case with a mark at
both ends. Profiles are small, whatever the corpus: RANKS trigrams of LANGUAGES languages, which go to every task.

Spark lowers and parts texts; their trigrams are counted row by row in numpy. So no trigram of a text is shuffled, but those of ids
that have several rows, whose counts are added up.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Trigrams of a profile, and languages that are told apart: the commonest.
RANKS, LANGUAGES = 300, 64


#: Bits of a code point within a trigram's number.
_BITS = 21


def marked_words(text: Column) -> Column:
    """A text's words in lower case, marks before, between and after them."""
    return F.concat(F.lit("_"), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", "_"), F.lit("_"))


def trigram_counts(marked: str) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of marked words as numbers in the strings' order, and how often each is there. A mark is never the middle of one."""
    x = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.int64)
    inner = x[1:-1] != ord("_")
    return np.unique((x[:-2] << 2 * _BITS | x[1:-1] << _BITS | x[2:])[inner], return_counts=True)


def _name(gram: int) -> str:
    return "".join(chr(gram >> k * _BITS & (1 << _BITS) - 1) for k in (2, 1, 0))


def _number(gram: str) -> int:
    return ord(gram[0]) << 2 * _BITS | ord(gram[1]) << _BITS | ord(gram[2])


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """key, gram and n of rows (key, marked): what a batch has of each key, to be added up."""
    schema = StructType([rows.schema[key], *StructType.fromDDL("gram string, n long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict = defaultdict(lambda: defaultdict(int))
            for k, marked in zip(batch.column(key).to_pylist(), batch.column("marked"), strict=True):
                for gram, n in zip(*(x.tolist() for x in trigram_counts(marked.as_py())), strict=True):
                    counts[k][gram] += n
            columns = [k for k, own in counts.items() for _ in own], [_name(g) for own in counts.values() for g in own], [n for own in counts.values() for n in own.values()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column(key).type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema).groupBy(key, "gram").agg(F.sum("n").alias("n"))


def _ranked(counts: DataFrame, key: str) -> DataFrame:
    """key, gram and rank (from 1) of counts (key, gram, n): the commonest RANKS, equal ones in order."""
    order = Window.partitionBy(key).orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKS).select(key, "gram", "rank")


def profiles(labelled: DataFrame) -> DataFrame:
    """lang, gram and rank of labelled texts (text, lang), for the LANGUAGES with the most texts; null labels teach nothing."""
    known = labelled.where("lang is not null").select("text", "lang")
    most = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    return _ranked(_counted(known.join(F.broadcast(most), "lang").select("lang", marked_words(F.col("text")).alias("marked")), "lang"), "lang")


def _judged(rows: DataFrame, learned: DataFrame) -> DataFrame:
    """_id, language and cost of rows (_id, marked), each a text of its own."""
    known = learned.select("lang", "gram", "rank").collect()  # RANKS of LANGUAGES at most
    langs, grams = sorted({r["lang"] for r in known}), np.array(sorted({_number(r["gram"]) for r in known}), np.int64)
    ranks = np.zeros((len(grams), len(langs)), np.int64)
    at = {x: k for k, x in enumerate(langs)}
    for r in known:
        ranks[np.searchsorted(grams, _number(r["gram"])), at[r["lang"]]] = r["rank"]
    schema = StructType([rows.schema["_id"], *StructType.fromDDL("language string, cost double")])

    def judge(marked: str) -> tuple[str | None, float | None]:
        own, n = trigram_counts(marked)
        if not len(own) or not len(grams):
            return None, None
        own = own[np.lexsort((own, -n))[:RANKS]]
        place = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        hit = np.flatnonzero(grams[place] == own)
        other = ranks[place[hit]]
        # A trigram that is in both profiles saves what lacking it would cost.
        saved = np.where(other > 0, RANKS - np.minimum(np.abs(hit[:, None] + 1 - other), RANKS), 0).sum(axis=0)
        best = int(np.argmax(saved))
        return (langs[best], RANKS - int(saved[best]) / len(own)) if saved[best] else (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(x.as_py()) for x in batch.column("marked")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _judged_together(rows: DataFrame, learned: DataFrame) -> DataFrame:
    """_id, language and cost of rows (_id, marked), those of one id being one text."""
    own = _ranked(_counted(rows, "_id"), "_id")
    sizes = own.groupBy("_id").agg(F.count(F.lit(1)).alias("_size"))
    both = own.select("_id", "gram", F.col("rank").alias("_own")).join(F.broadcast(learned), "gram")
    saved = both.groupBy("_id", "lang").agg(F.sum(F.lit(RANKS) - F.least(F.abs(F.col("_own") - F.col("rank")), F.lit(RANKS))).alias("saved"))
    best = saved.groupBy("_id").agg(F.min(F.struct(-F.col("saved"), "lang")).alias("best"))
    cost = F.lit(RANKS) + F.col("best.col1") / F.col("_size")
    found = best.join(sizes, "_id").select(F.col("_id").alias("_of"), F.col("best.lang").alias("language"), cost.alias("cost"))
    return rows.select("_id").distinct().join(found, F.col("_id") == F.col("_of"), "left").select("_id", "language", "cost")


def detected(texts: DataFrame, learned: DataFrame, id: str, text: str = "text") -> DataFrame:
    """id, language and cost of texts by learned profiles: the mean cost of a trigram, from 0 to RANKS.

    Rows of one id are one text. A text without a letter, a null one or a null id has language and cost null, and so has every text where
    nothing was learned; of equal languages the first in order is taken.
    """
    rows = texts.where(F.col(id).isNotNull()).select(F.col(id).alias("_id"), marked_words(F.col(text)).alias("marked"))
    repeated = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")
    if repeated.isEmpty():
        found = _judged(rows, learned)
    else:
        found = _judged(rows.join(repeated, "_id", "left_anti"), learned).union(_judged_together(rows.join(repeated, "_id", "left_semi"), learned))
    none = texts.where(F.col(id).isNull()).select(id).distinct().select(F.col(id).alias("_id"), F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("cost"))
    return found.union(none).select(F.col("_id").alias(id), "language", "cost")
