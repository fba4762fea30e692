"""Token counts of documents in flat token files, by a scan for separators.

A flat file is a run of ids in which an end-of-document id closes each document; there is no
index. Files are read as blocks. Within a block numpy finds all separators at once; a prefix
scan over the blocks of a file then gives each block the tokens and documents before it and
where the last separator before it stood, so that a document across any number of blocks is
stitched together. The prefix scan runs over runs of blocks first and then over their sums,
so that a file of any size is never one task's.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.tokens import BYTE_BPE, byte_bpe

#: Bytes of an id; 2 hold ids under 65,536.
END_ID, BLOCK, WIDTH = 50256, 1 << 16, 2
#: Blocks that one task scans by a sort; their sums are scanned above.
RUN = 4096
#: Blocks that are read in one go, and tasks that read.
RANGE_BLOCKS, MOST_READERS = 256, 50_000


def positioned(path: str) -> pa.NativeFile:
    """A file open for reads at any place, on whatever store its address names."""
    from pyarrow import fs

    uri = re.sub(r"^file:/(?!//)", "file:///", re.sub(r"^s3[an]://", "s3://", path))
    store, at = fs.FileSystem.from_uri(uri)
    return store.open_input_file(at)


def token_files(spark: SparkSession, path: str, block: int = BLOCK, width: int = WIDTH, opened: Callable[[str], pa.NativeFile] = positioned) -> DataFrame:
    """Blocks (file, block, ids) of raw files of little-endian unsigned ids of width 2 or 4 bytes.

    Spark only lists the files; each range of RANGE_BLOCKS blocks is then a row that some task reads by position, block by
    block, so a file may have any size and many tasks share it. An empty file is one block without ids; bytes that
    don't make whole ids are an error. opened takes the place of pyarrow's file systems for other stores.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    blocks = F.greatest(F.ceil(F.col("length") / (width * block)), F.lit(1))
    ranges = F.ceil(blocks / RANGE_BLOCKS)
    n = files.agg(F.sum(ranges)).first()[0] or 0
    each = files.select("file", "length", F.explode(F.sequence(F.lit(0).cast("long"), ranges - 1)).alias("range"))
    each = each.select("file", "length", (F.col("range") * RANGE_BLOCKS).alias("first"), (F.least((F.col("range") + 1) * RANGE_BLOCKS, blocks)).alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['file']} has {row['length']} bytes, which are no whole ids of {width}")
                with opened(row["file"]) as f:
                    f.seek(row["first"] * width * block)
                    for k in range(row["first"], row["end"]):
                        yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([k], pa.int64()), pa.array([f.read(width * block)], pa.binary())], names=["file", "block", "ids"])

    # a number of its own: rows of a few bytes would otherwise be put together in one task
    dealt = each.repartition(max(1, min(n, MOST_READERS)))
    return dealt.mapInArrow(run, "file string, block long, ids binary")


def token_stream(docs: DataFrame, path: str = BYTE_BPE, end_id: int = END_ID, block: int = BLOCK, width: int = WIDTH) -> DataFrame:
    """docs as flat files of full blocks, one file a partition, each document closed by end_id.

    Columns: file, block, ids, and doc_ids, whose documents end in the block, in order. Null
    and empty texts are closed at once. A retried partition gives the same file. Ids that
    don't fit the width are an error.
    """
    end, most = np.array([end_id], f"<u{width}"), (1 << 8 * width) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, name, number = byte_bpe(path), f"part-{TaskContext.get().partitionId()}", 0
        held, size, ends = [], 0, []  # arrays of ids, and (place of the end, doc_id)

        def out(final: bool) -> pa.RecordBatch:
            nonlocal held, size, ends, number
            flat = np.concatenate(held)
            blocks = -(-size // block) if final else size // block
            rows = [(flat[k * block : (k + 1) * block].tobytes(), [d for at, d in ends if at // block == k]) for k in range(blocks)]
            first, number = number, number + blocks
            held, size, ends = [flat[blocks * block :]], max(0, size - blocks * block), [(at - blocks * block, d) for at, d in ends if at >= blocks * block]
            return pa.RecordBatch.from_arrays([pa.array([name] * blocks, pa.string()), pa.array(range(first, number), pa.int64()), pa.array([x for x, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.list_(pa.int64()))], names=["file", "block", "ids", "doc_ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = bpe(text)
                if len(ids) and ids.max() > most:
                    raise ValueError(f"the id {ids.max()} needs more than {width} bytes")
                held += [ids.astype(end.dtype), end]
                size += len(ids) + 1
                ends.append((size - 1, doc_id))
                if size >= 4 * block:
                    yield out(final=False)
        if size:
            yield out(final=True)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "file string, block long, ids binary, doc_ids array<long>")


def separators(blocks: DataFrame, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """file, block, n (tokens), and ends, the places of all separators of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, f"<u{width}") for x in batch.column("ids").to_pylist()]
            ends = pa.array([np.flatnonzero(x == end_id).astype(np.int32) for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array([len(x) for x in found], pa.int64()), ends], names=["file", "block", "n", "ends"])

    return blocks.select("file", "block", "ids").mapInArrow(run, "file string, block long, n long, ends array<int>")


def prefixed(scanned: DataFrame) -> DataFrame:
    """scanned with start (tokens before the block in its file), before (documents that ended before it) and
    previous_end (the place in the file of the last separator before it, -1 if there is none)."""
    run = F.floor(F.col("block") / RUN)
    rows = scanned.withColumn("_run", run).withColumn("_docs", F.size("ends").cast("long")).withColumn("_last", F.try_element_at("ends", F.lit(-1)).cast("long"))
    within = Window.partitionBy("file", "_run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("n").over(within), F.lit(0))).withColumn("_before", F.coalesce(F.sum("_docs").over(within), F.lit(0)))
    rows = rows.withColumn("_previous", F.max(F.col("_start") + F.col("_last")).over(within))
    runs = rows.groupBy("file", "_run").agg(F.sum("n").alias("_n"), F.sum("_docs").alias("_d"), F.max(F.col("_start") + F.col("_last")).alias("_end"))
    above = Window.partitionBy("file").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "_run", "_end", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_run_start"), F.coalesce(F.sum("_d").over(above), F.lit(0)).alias("_run_before"))
    runs = runs.withColumn("_run_previous", F.max(F.col("_run_start") + F.col("_end")).over(above)).drop("_end")
    joined = rows.join(runs, ["file", "_run"])
    return joined.select(
        "file",
        "block",
        "n",
        "ends",
        (F.col("_run_start") + F.col("_start")).alias("start"),
        (F.col("_run_before") + F.col("_before")).alias("before"),
        F.coalesce(F.col("_run_start") + F.col("_previous"), "_run_previous", F.lit(-1)).alias("previous_end"),
    )


def _lengths():
    """By document that ends in the block: its place in the file and its tokens without the separator."""
    end = lambda i: F.col("start") + F.get("ends", i)
    last = lambda i: F.when(i == 0, F.col("previous_end")).otherwise(end(i - 1))
    return F.transform("ends", lambda _, i: F.struct((F.col("before") + i).alias("document"), (last(i) + 1).alias("first_token"), (end(i) - last(i) - 1).alias("n_tokens")))


def counted(blocks: DataFrame, end_id: int = END_ID, width: int = WIDTH) -> DataFrame:
    """file, document (its place, from 0), first_token, n_tokens (without the separator) and ended, of every document.

    blocks must be cheap to read again. Tokens after a file's last separator are a document
    that has not ended. Two separators in a row hold a document of no tokens. Files without
    tokens, and an empty table, give no rows.
    """
    found = written(prefixed(separators(blocks, end_id, width)), "separators")
    whole = found.select("file", F.explode(_lengths()).alias("d")).select("file", "d.*", F.lit(True).alias("ended"))
    tails = found.groupBy("file").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).cast("long").alias("document"), F.coalesce(F.max(F.col("start") + F.try_element_at("ends", F.lit(-1))), F.lit(-1)).alias("last"))
    tails = tails.where("n > last + 1").select("file", "document", (F.col("last") + 1).alias("first_token"), (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return whole.union(tails)


def document_counts(docs: DataFrame, path: str = BYTE_BPE, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """doc_id, file, first_token and n_tokens of every row of docs, scanned from the flat files made of them.

    Null and empty texts have no tokens; repeated rows are documents of their own. Extra
    columns are left out.
    """
    stream = written(token_stream(docs, path, end_id, block), "token_files")
    found = prefixed(separators(stream, end_id))
    owners = stream.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "doc_ids")
    joined = found.join(owners, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    each = joined.select("file", F.explode(F.arrays_zip("doc_ids", _lengths().alias("d"))).alias("x"))
    return each.select(F.col("x.doc_ids").alias("doc_id"), "file", F.col("x.d.first_token").alias("first_token"), F.col("x.d.n_tokens").alias("n_tokens"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents; null and empty texts have none, repeated rows each their own, an empty table no rows."""
    return document_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_tokens")
