"""Podcast feeds as a data source of Spark: spark.read.format("podcast_feeds").

A response is a JSON object of a feed with its items, or of a list of feeds; a file has one or one a line. Each address is a
partition, so that fetching is the executors' work, and what can't be fetched or read is a row with an error.
Where Spark pushes filters to Python sources (spark.sql.python.filterPushdown.enabled), those on address leave out
the other partitions.

Options: addresses, a JSON list of them; or path, a file or a folder whose files are the addresses. registered(spark, fetch) gives
another way to fetch an address than pyarrow's file systems, as over the network with a key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

NAME, ROWS = "podcast_feeds", 4096
SCHEMA = (
    "address string, line long, feed_id string, feed_title string, feed_author string, feed_language string, feed_rank long, "
    "episode_id string, title string, description string, audio_url string, published long, error string"
)
_ARROW = {"string": pa.string(), "long": pa.int64()}
#: Names of the responses' fields, by column.
FEED = {"feed_id": "id", "feed_title": "title", "feed_author": "author", "feed_language": "language"}
ITEM = {"episode_id": "id", "title": "title", "description": "description", "audio_url": "enclosureUrl"}

#: The lines of an address's response.
Fetch = Callable[[str], Iterable[str]]


def opened(address: str) -> Iterator[str]:
    """Lines of a file in any file system that pyarrow knows, as they are read."""
    where, at = fs.FileSystem.from_uri(address) if "://" in address or address.startswith("file:") else (fs.LocalFileSystem(), address)
    with where.open_input_stream(at) as stream:
        rest = b""
        while block := stream.read(1 << 20):
            *lines, rest = (rest + block).split(b"\n")
            yield from (x.decode("utf-8", "replace") for x in lines)
        yield rest.decode("utf-8", "replace")


def files_of(path: str) -> list[str]:
    """A file itself, or a folder's files but those whose names begin with _ or a dot."""
    where, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    scheme = path.partition(":")[0] + "://" if ":" in path else ""
    found = where.get_file_info(at)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return [path]
    inside = where.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(scheme + x.path for x in inside if x.type == fs.FileType.File and not any(p[:1] in "_." for p in x.path[len(at) :].split("/") if p))


def _text(x) -> str | None:
    return None if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)


def rows_of(response: str, first_rank: int) -> Iterator[dict]:
    """A row for each item of each feed, one without an episode for a feed without items. Raises ValueError for anything else."""
    found = json.loads(response)
    feeds = found.get("feeds", [found]) if isinstance(found, dict) else None
    if not isinstance(feeds, list):
        raise ValueError("neither a feed nor a list of feeds")
    for rank, feed in enumerate(feeds, first_rank):
        if not isinstance(feed, dict) or feed.get("id") is None:
            raise ValueError("a feed without an id")
        own = {c: _text(feed.get(name)) for c, name in FEED.items()} | {"feed_rank": rank}
        items = [x for x in feed.get("items") or [] if isinstance(x, dict)]
        for item in items or [{}]:
            published = item.get("datePublished")
            yield own | {c: _text(item.get(name)) for c, name in ITEM.items()} | {"published": published if isinstance(published, int) and abs(published) < 1 << 63 else None}


@dataclass
class Address(InputPartition):
    address: str


class FeedReader(DataSourceReader):
    """A partition for each address."""

    def __init__(self, options: dict[str, str], fetch: Fetch):
        self.options, self.fetch, self.wanted = dict(options), fetch, None

    def partitions(self) -> list[Address]:
        found = json.loads(self.options["addresses"]) if "addresses" in self.options else files_of(self.options["path"])
        return [Address(x) for x in found if self.wanted is None or x in self.wanted]

    def read(self, partition: Address) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, _ARROW[kind]) for c, kind in (x.split() for x in SCHEMA.split(", "))])
        held: list[dict] = []

        def rows() -> Iterator[dict]:
            line = rank = 0
            try:
                for response in self.fetch(partition.address):
                    if response.strip():
                        try:
                            own = list(rows_of(response, rank))
                            yield from ({"line": line} | r for r in own)
                            rank = own[-1]["feed_rank"] + 1 if own else rank
                        except (ValueError, RecursionError) as error:
                            yield {"line": line, "error": f"{type(error).__name__}: {error}"[:500]}
                    line += 1
            except Exception as error:  # whatever a fetch may raise is this address's error
                yield {"error": f"{type(error).__name__}: {error}"[:500]}

        for row in rows():
            held.append({"address": partition.address} | row)
            if len(held) == ROWS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)


class PruningFeedReader(FeedReader):
    """Leaves out addresses that filters leave out. Spark takes such a reader only where it may push filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("address",):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = own if self.wanted is None else self.wanted & own
            else:
                yield f


def registered(spark: SparkSession, fetch: Fetch = opened, name: str = NAME) -> None:
    """Makes the format `name` known to the session, with this way to fetch an address."""
    kind = PruningFeedReader if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true" else FeedReader

    class Feeds(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: StructType) -> DataSourceReader:
            return kind(self.options, fetch)

    spark.dataSource.register(Feeds)


def feeds(spark: SparkSession, path: str) -> DataFrame:
    """Rows of SCHEMA from the files at path."""
    registered(spark)
    return spark.read.format(NAME).option("path", path).load()
