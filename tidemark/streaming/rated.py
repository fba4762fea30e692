"""A table as a stream of at most so many records a trigger: spark.readStream.format("rated_table").

The table is Parquet with a column of whole numbers that grows, its offset. Each trigger admits the next records
by that column, `most` at most, and its range is cut into parts that are read by tasks of their own, row groups
outside the range being skipped by their statistics. Options: path, offset (the column), most, parts, and over and
upto, which bound the offsets that a stream takes.

A stream of this source has a Python process of its own beside the driver, and reads what pyarrow can open. It is for a
table that grows. A table that is whole is replayed from files of `most` records (`cut`), of which Spark's own file source
takes one a trigger (`file_a_trigger`): that needs no such process, and a table may be in any store that Spark reads.

A trigger costs what Spark's logs and a job cost, however few its records. A long table is therefore replayed by several
streams, each of whole triggers: by folders (`cut`) or by ranges of offsets (`ranges_of`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.sources.tables import checkpointed, shared_folder

NAME, MOST, PARTS = "rated_table", 200, 2
BEFORE_ALL, AFTER_ALL = -(1 << 62), 1 << 62
#: Streams that replay a table at once, and triggers of each at least.
STREAMS, TRIGGERS = 12, 20
#: The first file's time, in milliseconds: the start of 2000.
SINCE = 946_684_800_000


def dataset(path: str) -> ds.Dataset:
    where, at = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    return ds.dataset(at, format="parquet", filesystem=where)


@dataclass
class Range(InputPartition):
    """Offsets over `start`, up to `end`."""

    start: int
    end: int


class RatedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.column = options["path"], options["offset"]
        self.most, self.parts = int(options.get("most", MOST)), int(options.get("parts", PARTS))
        self.over, self.upto = int(options.get("over", BEFORE_ALL)), int(options.get("upto", AFTER_ALL))
        self.now: int | None = None

    def initialOffset(self) -> dict:
        return {"at": self.over}

    def _least(self) -> int | None:
        at = ds.field(self.column)
        found = [pc.min(b.column(0)).as_py() for b in dataset(self.path).to_batches(columns=[self.column], filter=(at > self.over) & (at <= self.upto)) if b.num_rows]
        return min((x for x in found if x is not None), default=None)

    def latestOffset(self) -> dict:
        start = self.now
        if start is None:
            least = self._least()
            if least is None:
                return self.initialOffset()
            start = least - 1
        own, at, span = dataset(self.path), ds.field(self.column), self.most
        while True:  # wider spans until one holds `most` records, or all there are
            end = min(start + span, self.upto)
            found = own.to_table(columns=[self.column], filter=(at > start) & (at <= end)).column(0).to_numpy()
            if len(found) >= self.most or end == self.upto or not own.scanner(columns=[self.column], filter=(at > end) & (at <= self.upto)).head(1).num_rows:
                break
            span *= 4
        if len(found):
            last = min(self.most, len(found)) - 1
            self.now = int(np.partition(found, last)[last])
        return self.initialOffset() if self.now is None else {"at": self.now}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if self.now is None:  # a query that starts again is told its last batch first
            self.now = end["at"]
        if start["at"] >= end["at"]:
            return []
        first = start["at"] if start["at"] > BEFORE_ALL else (self._least() or 0) - 1
        step = max(1, -(-(end["at"] - first) // self.parts))
        return [Range(a, min(a + step, end["at"])) for a in range(first, end["at"], step)]

    def commit(self, end: dict) -> None:
        if self.now is None:
            self.now = end["at"]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        inside = (ds.field(self.column) > partition.start) & (ds.field(self.column) <= partition.end)
        yield from dataset(self.path).to_batches(filter=inside)


class RatedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return from_arrow_schema(dataset(self.options["path"]).schema, prefer_timestamp_ntz=True)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RatedReader(self.options)


def rated_stream(spark: SparkSession, path: str, offset: str, most: int = MOST, parts: int = PARTS, over: int = BEFORE_ALL, upto: int = AFTER_ALL) -> DataFrame:
    """The rows of a Parquet table as a stream, by a column of growing numbers, `most` a trigger; of offsets over one and up to
    another, if given. Rows that are equal in it come together."""
    spark.dataSource.register(RatedTable)
    return spark.readStream.format(NAME).option("path", path).option("offset", offset).option("most", most).option("parts", parts).option("over", over).option("upto", upto).load()


def _parts(rows: DataFrame, by: Column) -> DataFrame:
    """Rows dealt out by ranges of `by`, with the number of each one's part."""
    return checkpointed(rows.repartitionByRange(by).withColumn("own_part", F.spark_partition_id()), "offsets")


def _placed(parts: DataFrame, sizes: dict[int, int], by: Column) -> DataFrame:
    """Rows of parts with their place from 1: each part is ranked by itself, and numbered on from where the parts before it end."""
    before, done = [], 0
    for part, n in sorted(sizes.items()):
        before.append((part, done))
        done += n
    counted = parts.sparkSession.createDataFrame(before, "own_part int, rows_before long")
    place = F.row_number().over(Window.partitionBy("own_part").orderBy(by)) + F.col("rows_before")
    return parts.join(F.broadcast(counted), "own_part").withColumn("own_place", place).drop("own_part", "rows_before")


def ranges_of(table: DataFrame, offset: str, most: int = MOST, streams: int = STREAMS, triggers: int = TRIGGERS) -> list[tuple[int, int, int]]:
    """Ranges of offsets (over, upto) that hold as many whole triggers each, and the number of the first trigger: at most
    `streams`, of `triggers` at least. The first and the last are open, and a table in which offsets repeat is one range."""
    whole = [(BEFORE_ALL, AFTER_ALL, 0)]
    known = table.select(F.col(offset).cast("long").alias("at")).where("at is not null")
    n = -(-known.count() // most)
    each = max(triggers, -(-n // streams))
    if n <= each:
        return whole
    parts = _parts(known, F.col("at"))
    sizes = parts.groupBy("own_part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("at").alias("distinct")).collect()
    if any(r["n"] != r["distinct"] for r in sizes):
        return whole
    places = _placed(parts, {r["own_part"]: r["n"] for r in sizes}, F.col("at"))
    ends = [r["at"] for r in places.where(F.col("own_place") % (each * most) == 0).orderBy("at").collect()]
    return [(a, b, k * each) for k, (a, b) in enumerate(zip([BEFORE_ALL, *ends], [*ends, AFTER_ALL], strict=True))]


def cut(table: DataFrame, offset: str, most: int = MOST, streams: int = STREAMS, triggers: int = TRIGGERS) -> list[tuple[str, int]]:
    """The rows of a table as files of `most`, by its offset (nulls last), in folders of as many files each: at most `streams`
    folders, of `triggers` files at least. Returns each folder and the number of its first file; none for an empty table.
    Offsets may repeat. Files are a second apart by their times of modification, by which Spark's file source takes them."""
    by = F.col(offset).asc_nulls_last()
    parts = _parts(table, by)
    sizes = {r["own_part"]: r["count"] for r in parts.groupBy("own_part").count().collect()}
    rows = sum(sizes.values())
    if not rows:
        return []
    n = -(-rows // most)
    each = max(triggers, -(-n // streams))
    at = f"{shared_folder(table.sparkSession)}/cut-{uuid.uuid4().hex}"
    number = F.floor((F.col("own_place") - 1) / most)
    placed = _placed(parts, sizes, by).withColumn("own_folder", F.floor(number / each))
    # a task has all rows of the files that it writes, in their order, so that each `most` of a folder are one file's
    placed.repartition(-(-n // triggers), number).sortWithinPartitions("own_folder", "own_place").write.option("maxRecordsPerFile", most).partitionBy("own_folder").parquet(at)
    _dated(table.sparkSession, at, rows, most)
    return [(f"{at}/own_folder={k}", k * each) for k in range(-(-n // each))]


def _dated(spark: SparkSession, at: str, rows: int, most: int) -> None:
    """Dates files by the place of their first row, a second apart from 2000 on. Raises an error if they don't hold the rows
    1 to `rows` by `most`, or if their store keeps no such times."""
    place, file = F.col("own_place"), F.col("_metadata.file_path").alias("file")
    files = spark.read.parquet(at).groupBy(file).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")).orderBy("first").collect()
    if [(r["first"], r["last"], r["n"]) for r in files] != [(k, min(k + most - 1, rows), min(most, rows - k + 1)) for k in range(1, rows + 1, most)]:
        raise RuntimeError(f"{at} doesn't hold {rows} rows as files of {most}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k, r in enumerate(files):
        path, time = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["file"])), SINCE + 1000 * k
        store = path.getFileSystem(conf)
        store.setTimes(path, time, -1)
        if store.getFileStatus(path).getModificationTime() != time:
            raise RuntimeError(f"{at} is in a store that sets no times of modification")


def file_a_trigger(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The files of a folder as a stream, one a trigger, by their times of modification, however far these are apart."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("maxFileAge", "36500d").parquet(folder)


class BatchSizes(StreamingQueryListener):
    """Rows and start time of each batch that had rows, in the order of progress."""

    def __init__(self):
        self.rows: list[int] = []
        self.starts: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self.rows.append(event.progress.numInputRows)
            self.starts.append(event.progress.timestamp)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
