"""Chunks of long texts, and their vectors."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import vectors as V
from tidemark.functions.vectors import EPSILON

MODEL_TOKENS, SPECIAL, OVERLAP, MARGIN, LEAST_WINDOW, DIMENSIONS = 256, 2, 32, 8, 8, 64

Encoder = Callable[[list[str]], np.ndarray]
#: A text's token ids, and the text of some; made where it is used, as a tokenizer may not travel.
Codec = tuple[Callable[[str], list[int]], Callable[[list[int]], str]]


@dataclass(frozen=True)
class EncoderSettings:
    """A model's name, which its vectors carry, and how long texts are dealt to it."""

    model: str = f"hashing-{DIMENSIONS}"
    tokens: int = MODEL_TOKENS
    overlap: int = OVERLAP
    margin: int = MARGIN
    batch: int = 4
    dimensions: int = DIMENSIONS


def window_of(tokens: int = MODEL_TOKENS, model_tokens: int = MODEL_TOKENS, special: int = SPECIAL, overlap: int = OVERLAP, margin: int = MARGIN) -> tuple[int, int]:
    """Tokens of a window, and from one window's start to the next's."""
    window = max(LEAST_WINDOW, min(tokens, model_tokens) - special - margin)
    return window, max(1, window - overlap)


def windows(tokens: Column, window: int, stride: int) -> Column:
    """Arrays of tokens, one a window; the last is the first that reaches the end. No tokens, no window."""
    n = F.size(tokens)
    last = F.greatest(F.lit(0), F.ceil((n - window) / F.lit(stride)).cast("int"))
    starts = F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda k: k * stride)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(tokens, s + 1, window))


def chunks(docs: DataFrame, text: str = "text", **settings: int) -> DataFrame:
    """doc_id, chunk (from 0), n_tokens and chunk_text of whole texts; tokens are words between white space. Blank texts have none."""
    window, stride = window_of(**settings)
    split = docs.select("doc_id", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "").alias("_tokens"))
    each = split.select("doc_id", F.posexplode(windows(F.col("_tokens"), window, stride)).alias("chunk", "_own"))
    return each.select("doc_id", "chunk", F.size("_own").alias("n_tokens"), F.array_join("_own", " ").alias("chunk_text"))


def file_codec(path: str) -> Callable[[], Codec]:
    """The codec of a tokenizer's JSON file, which every worker can read."""

    def make() -> Codec:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        return lambda text: own.encode(text, add_special_tokens=False).ids, own.decode

    return make


def token_chunks(docs: DataFrame, make: Callable[[], Codec], text: str = "text", **settings: int) -> DataFrame:
    """chunks() by a tokenizer's own tokens: each window's text is what its ids decode to.

    Windows that decode to blanks are left out and the others are numbered without gaps. A null or blank text has none.
    """
    window, stride = window_of(**settings)
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("chunk int, n_tokens int, chunk_text string")])

    def of(doc_id, ids: list[int], decode: Callable[[list[int]], str]) -> Iterator[tuple]:
        k = 0
        for start in range(0, max(1, len(ids) - window + stride), stride):
            own = ids[start : start + window]
            part = decode(own).strip() if own else ""
            if part:
                yield doc_id, k, len(own), part
                k += 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, decode = make()
        for batch in batches:
            for doc_id, x in zip(batch["doc_id"].astype(object), batch["_text"], strict=True):
                found = list(of(None if pd.isna(doc_id) else doc_id, encode(x), decode)) if x else []
                if found:
                    yield pd.DataFrame(found, columns=schema.names)

    return docs.select("doc_id", F.trim(F.coalesce(F.col(text), F.lit(""))).alias("_text")).mapInPandas(run, schema)


def by_batches(encode: Encoder, size: int) -> Encoder:
    """encode, given so many texts at a time."""
    return lambda texts: np.concatenate([encode(texts[k : k + size]) for k in range(0, len(texts), size)])


def hashing_encoder(texts: list[str]) -> np.ndarray:
    """Unit vectors of hashed words: the same everywhere, without a model."""
    out = np.zeros((len(texts), DIMENSIONS))
    for row, text in zip(out, texts, strict=True):
        for word in text.lower().split():
            h = zlib.crc32(word.encode())
            row[h % DIMENSIONS] += 1.0 if h >> 16 & 1 else -1.0
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + EPSILON)


def chunk_vectors(chunked: DataFrame, encode: Encoder = hashing_encoder) -> DataFrame:
    """doc_id, vector and n_tokens of chunks (doc_id, chunk_text, n_tokens), in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.ascontiguousarray(encode(batch.column("chunk_text").to_pylist()), np.float64)
                lists = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, vectors.shape[1], np.int32), vectors.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, batch.column("n_tokens").cast(pa.float64())], names=["doc_id", "vector", "n_tokens"])

    kept = chunked.select("doc_id", "chunk_text", "n_tokens")
    return kept.mapInArrow(run, StructType([chunked.schema["doc_id"], *StructType.fromDDL("vector array<double>, n_tokens double")]))


def embedded(chunked: DataFrame, encode: Encoder = hashing_encoder) -> DataFrame:
    """doc_id, embedding and n_chunks: the mean of a document's chunk vectors weighted by their tokens, at length one.

    Chunks are encoded where they are. A summarizer adds them up as whole vectors, before the shuffle and after it.
    """
    summary = Summarizer.metrics("mean", "count").summary(array_to_vector("vector"), F.col("n_tokens"))
    means = chunk_vectors(chunked, encode).groupBy("doc_id").agg(summary.alias("s")).select("doc_id", vector_to_array("s.mean").alias("v"), F.col("s.count").alias("n_chunks"))
    length = V.norm(F.col("v")) + EPSILON
    return means.withColumn("_length", length).select("doc_id", F.transform("v", lambda x: (x / F.col("_length")).cast("float")).alias("embedding"), "n_chunks")


def embedded_documents(docs: DataFrame, encode: Encoder = hashing_encoder, dimensions: int = DIMENSIONS) -> DataFrame:
    """Vectors of all documents; one without a chunk has the zero vector."""
    found = embedded(chunks(docs), encode)
    zero = F.array_repeat(F.lit(0.0).cast("float"), dimensions)
    return docs.select("doc_id").distinct().join(found, "doc_id", "left").select("doc_id", F.coalesce("embedding", zero).alias("embedding"), F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))


def embedded_transcripts(transcripts: DataFrame, settings: EncoderSettings | None = None, encode: Encoder = hashing_encoder, make: Callable[[], Codec] | None = None, now: Column | None = None) -> DataFrame:
    """episode_id, date, embedding, model and created_at of transcripts (episode_id, transcript, maybe date).

    Each id has one row for a model. Chunks are of the codec's tokens if one is given, else of words; a text without any has
    the zero vector.
    """
    own = settings or EncoderSettings()
    windows_of = {"tokens": own.tokens, "overlap": own.overlap, "margin": own.margin}
    docs = transcripts.select(F.col("episode_id").alias("doc_id"), F.col("transcript").alias("text"))
    parts = token_chunks(docs, make, **windows_of) if make else chunks(docs, **windows_of)
    found = embedded(parts, by_batches(encode, own.batch)).withColumnRenamed("doc_id", "_of")
    date = F.col("date") if "date" in transcripts.columns else F.lit(None)
    each = transcripts.groupBy("episode_id").agg(F.max(date.cast("string")).alias("date"))
    zero = F.array_repeat(F.lit(0.0).cast("float"), own.dimensions)
    joined = each.join(found, F.col("episode_id") == F.col("_of"), "left")
    return joined.select("episode_id", "date", F.coalesce("embedding", zero).alias("embedding"), F.lit(own.model).alias("model"), (now if now is not None else F.current_timestamp()).alias("created_at"))
