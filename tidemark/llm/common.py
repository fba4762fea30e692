"""What the operators share: tables that cut lineage, ranks without a single task, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: The columns of the documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows of a batch that are worked on at once, so that a Python worker holds few texts.
ROWS_AT_ONCE = 1024

#: Rows that one task may rank by a sort. Larger groups are ranked in several tasks.
ROWS_A_RANKED_BUCKET = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, one machine makes its own; a cluster can't."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and readable after any executor is lost."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._written_at = at
    return out


def discarded(*tables: DataFrame) -> None:
    """Deletes the files of tables made by written, once nothing will read them again."""
    for df in tables:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_at)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def private(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of the operator's own, which df doesn't have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


#: Values of the salt that parts equal rows.
SALTS = 64
SALT = "_salt"


def salted(df: DataFrame) -> DataFrame:
    """df with SALT, by which ranked deals rows that are equal; to be written before it is read twice."""
    return df.withColumn(SALT, (F.monotonically_increasing_id() % SALTS).cast("int"))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: str | StructType) -> DataFrame:
    """Rows of each Arrow batch to columns of other rows. make() runs once a task and returns the function of a batch."""
    out = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS_AT_ONCE):
                columns = step(whole.slice(k, ROWS_AT_ONCE))
                if columns is not None:
                    arrays = [x if isinstance(x, pa.Array) else pa.array(x, f.type, from_pandas=True) for f in arrow for x in [columns[f.name]]]
                    yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)
        pa.default_memory_pool().release_unused()  # the worker lives on, idle

    return df.mapInArrow(run, out)


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, rows: int | None = None) -> DataFrame:
    """df, a written table with SALT, with column `name`: a gapless rank from 0 within each value of keys.

    A group of any size is dealt into hashed buckets that are ranked apart; the counts of
    the buckets give each its offset. Rows equal in all of order must be alike, for which of them has
    which rank is left open; the salt parts them too. rows: how many df has, where that is known.
    """
    n = df.count() if rows is None else rows
    buckets = max(64, n // ROWS_A_RANKED_BUCKET)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, SALT), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order, SALT)
    numbered = dealt.withColumn("_at", F.row_number().over(within) - 1)
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = numbered.join(offsets, same, "left")
    return joined.withColumn(name, (F.col("_offset") + F.col("_at")).cast("long")).drop("_bucket", "_b", "_offset", "_at", "_n", SALT, *(f"_k{i}" for i in range(len(keys))))
