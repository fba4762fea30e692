"""Files as rows of their paths and lengths, read in part by executors."""

from __future__ import annotations

from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Opens a path as Spark writes it, for reading at any place.
Opener = Callable[[str], BinaryIO]


def opened(path: str) -> BinaryIO:
    """A file in any file system that pyarrow knows. Others need an Opener of their own."""
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    where, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return where.open_input_file(at)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path and length of files that aren't empty; their contents aren't read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").cast("long").alias("length"))
