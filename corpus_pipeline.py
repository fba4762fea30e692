"""The corpus pipeline: stages over documents, each a Parquet table that the next one reads.

Every stage but the last returns the columns of documents. Quality drops the documents that
its rules reject, near-duplicates all but one of each component, decontamination those that
hold a benchmark passage; personal data are replaced by their kind; packing returns places
of pieces in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, near_copies, packing, pii, quality
from tidemark.llm.common import DOCUMENT_COLUMNS, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quality keeps; null and empty texts go, repeated rows share their verdict, extra columns go."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return quality.judged(docs).where("kept").select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, repeated rows among them; null and empty texts are one group."""
    return near_copies.without_near_copies(docs.select(*DOCUMENT_COLUMNS))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; null and empty texts stay, repeated rows share their verdict."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs.select(*DOCUMENT_COLUMNS), benchmark).select(*DOCUMENT_COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by kind, n_chars counted again; null texts stay null."""
    clean = pii.redacted(docs.select(*DOCUMENT_COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces; a null or empty text is its end alone, repeated rows are packed each."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: SQL cannot express the components of fingerprints or the tokens' packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over documents in turn; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
