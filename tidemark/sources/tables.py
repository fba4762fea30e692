"""A table layer on Parquet folders: create, read, overwrite, append and keyed replacement.

A table is a folder of versions and a pointer file naming the current one. A writer fills a new
version and then moves the pointer, so a reader never sees half a write. Tables that are
partitioned rewrite only the partitions that a merge touches; the others are linked by path.
Everything goes through Hadoop's file system, so a path may be in any store that Spark reads.
"""

from __future__ import annotations

import json
import logging
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Table:
    """A table at a path, with a schema and maybe a partition column, whose values part it, or are dealt by hash into
    so many buckets."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition: str | None = None, buckets: int = 0) -> None:
        self.spark, self.path, self.schema, self.partition, self.buckets = spark, path.rstrip("/"), schema, partition, buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        at = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self._conf), at

    def state(self) -> dict | None:
        """The current parts (partition value to folder; "" if there is no partition), and the batches applied."""
        fs, at = self._at("current.json")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _part(self) -> Column:
        """The name of a row's part."""
        value = F.pmod(F.xxhash64(self.partition), F.lit(self.buckets)) if self.buckets else F.col(self.partition)
        return F.coalesce(value.cast("string"), F.lit("null"))

    def _set(self, state: dict) -> None:
        """Makes state the current one, if it was made from the one that is."""
        now = (self.state() or {}).get("version", 0)
        if now != state.get("version", 0):
            raise RuntimeError(f"{self.path} has changed since it was read: version {now}")
        state = state | {"version": now + 1}
        fs, new = self._at(f"current-{uuid.uuid4().hex}.json")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        _, at = self._at("current.json")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        option = self.spark.sparkContext._gateway.new_array(rename, 1)
        option[0] = rename.OVERWRITE
        context.rename(new, at, option)

    def exists(self) -> bool:
        return self.state() is not None

    def ensure(self) -> Table:
        """Creates the table empty, if it isn't there."""
        if not self.exists():
            self._set({"parts": {}, "batches": {}})
        return self

    def read(self) -> DataFrame:
        """The table's rows; none if it isn't there (a tolerant scan). Columns added later are null in older rows."""
        state = self.state()
        folders = [x for v in state["parts"].values() for x in v] if state else []
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # later columns stand behind the schema's own
        found = self.spark.read.option("mergeSchema", True).parquet(*folders)
        return found.select(*[c for c in self.schema.names if c in found.columns], *[c for c in found.columns if c not in self.schema.names])

    def _write(self, df: DataFrame) -> dict[str, list[str]]:
        """df as new folders, by partition value."""
        folder = f"{self.path}/data-{uuid.uuid4().hex}"
        if not self.partition:
            df.write.parquet(folder)
            return {"": [folder]}
        # the value is written both as a folder and, so that each folder reads alone, as a column
        df.withColumn("_part", self._part()).write.partitionBy("_part").parquet(folder)
        fs, at = self._at(folder.rpartition("/")[2])
        return {x.getPath().getName().removeprefix("_part="): [x.getPath().toString()] for x in fs.listStatus(at) if x.getPath().getName().startswith("_part=")}

    def overwrite(self, df: DataFrame) -> int:
        """Replaces all rows by df's and returns how many there are."""
        state = self.state() or {"batches": {}}
        self._set(state | {"parts": self._write(df)})
        return self.read().count()

    def append(self, df: DataFrame) -> None:
        """Adds df's rows; columns that the table lacks become its columns."""
        state = self.state() or {"parts": {}, "batches": {}}
        for value, folders in self._write(df).items():
            state["parts"].setdefault(value, []).extend(folders)
        self._set(state)

    def merge(self, source: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], writer: str = "", batch_id: int | None = None) -> bool:
        """Replaces the rows by how(rows, source); of a partitioned table, only in the partitions that source has.

        A batch of a writer is applied once: a batch_id up to its last one is skipped, and False returned.
        """
        state = self.state() or {"parts": {}, "batches": {}}
        if batch_id is not None and batch_id <= state["batches"].get(writer, -1):
            return False
        if self.partition:
            values = [r[0] for r in source.select(self._part()).distinct().collect()]
            # as many as a batch has days, or buckets
            folders = [x for v in values for x in state["parts"].get(v, [])]
            target = self.spark.read.option("mergeSchema", True).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)
            state["parts"] |= self._write(how(target, source))
        else:
            state["parts"] = self._write(how(self.read(), source))
        if batch_id is not None:
            state["batches"][writer] = batch_id
        self._set(state)
        return True

    def compact(self, files: int = 1) -> None:
        """Rewrites each partition's folders as one, of so many files."""
        state = self.state()
        for value, folders in (state or {"parts": {}})["parts"].items():
            folder = f"{self.path}/data-{uuid.uuid4().hex}"
            self.spark.read.option("mergeSchema", True).parquet(*folders).coalesce(files).write.parquet(folder)
            state["parts"][value] = [folder]
        if state:
            self._set(state)

    def vacuum(self) -> int:
        """Deletes the data folders of versions before the current one, once no reader is left on them; how many there were."""
        used = {x.split("/data-")[1].split("/")[0] for v in (self.state() or {"parts": {}})["parts"].values() for x in v}
        fs, root = self._at("")
        old = [x.getPath() for x in fs.listStatus(root) if x.getPath().getName().startswith("data-") and x.getPath().getName()[5:] not in used]
        for at in old:
            fs.delete(at, True)
        return len(old)

    def existing_ids(self, column: str) -> DataFrame:
        """Distinct ids as strings; join against them rather than collect them."""
        return self.read().select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()


def tolerant_read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files at a path with this schema; no rows if the path isn't there or can't be read as such."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.limit(1).collect()  # a file that isn't Parquet shows only now
        return found
    except Exception as error:
        logging.getLogger(__name__).warning("%s can't be read: %s", path, error)
        return spark.createDataFrame([], schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, one machine makes its own; a cluster can't."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def checkpointed(df: DataFrame, name: str) -> DataFrame:
    """df computed once, in the folder that the cluster shares; it outlives any executor."""
    at = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
