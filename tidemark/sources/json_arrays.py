"""Objects of JSON arrays of any size, read by ranges of bytes.

Whether a byte is inside a string, and how deep it is in brackets, hangs on all bytes before it. For each range a first
pass finds what it does to either: for each state that it might begin in, the state that it ends in and the
change of depth. Composed in order (a row a range) that gives the true state where each range begins; a second pass
then cuts out the objects that begin in a range, reading on where one ends behind it.

Both passes work on whole ranges in numpy. Ranges of a file are tasks' work like those of other files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.files import Opener, opened

#: Bytes of a range, and those read at once behind its end.
RANGE, ONWARD = 4 << 20, 1 << 18
#: Tasks there are at most; beyond that each has several ranges.
MOST_TASKS = 20_000
#: States between two bytes: outside strings, in one, and in one after a backslash.
OUTSIDE, INSIDE, ESCAPED = range(3)
_SUMMARY = "path string, k long, start long, length long, ends array<int>, changes array<long>"


def read_states(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Of bytes that begin in a state: 1 at each bracket that opens outside strings, -1 at one that closes, else 0; and the last state."""
    n = len(data)
    at = np.arange(n, dtype=np.int32)
    slash = data == ord("\\")
    # The last byte before each one that is no backslash; before the first stands one, unless the state says otherwise.
    plain = np.maximum.accumulate(np.where(slash, np.int32(-2 if state == ESCAPED else -1), at))
    before = np.concatenate(([np.int32(-2 if state == ESCAPED else -1)], plain[:-1]))
    escaped = (at - 1 - before) % 2 == 1
    quotes = (data == ord('"')) & ~escaped
    inside = (np.cumsum(quotes, dtype=np.int32) + (state != OUTSIDE)) % 2 == 1
    steps = np.zeros(n, np.int8)
    steps[((data == ord("{")) | (data == ord("["))) & ~inside] = 1
    steps[((data == ord("}")) | (data == ord("]"))) & ~inside] = -1
    if not n:
        return steps, state
    open_slash = (n - 1 - int(plain[-1])) % 2 == 1
    return steps, OUTSIDE if not inside[-1] else ESCAPED if open_slash else INSIDE


def summary(data: np.ndarray) -> tuple[list[int], list[int]]:
    """For each state that bytes may begin in, the state that they end in and their change of depth. They are looked through once, unless the
    first is one that a backslash before them matters to."""
    steps, end = read_states(data, OUTSIDE)
    depth = int(steps.sum(dtype=np.int64))
    counts = np.bincount(data, minlength=256)
    whole = int(counts[ord("{")] + counts[ord("[")] - counts[ord("}")] - counts[ord("]")])
    raw = data[-1024:].tobytes()
    slashes = len(raw) - len(raw.rstrip(b"\\"))
    if slashes == len(raw) or data[0] in b'"\\':
        found = [(steps, end), *(read_states(data, s) for s in (INSIDE, ESCAPED))]
        return [e for _, e in found], [int(x.sum(dtype=np.int64)) for x, _ in found]
    # What is outside strings from the one state is inside from the other.
    other = OUTSIDE if end != OUTSIDE else ESCAPED if slashes % 2 else INSIDE
    return [end, other, other], [depth, whole - depth, whole - depth]


class Cut:
    """Objects that begin at depth 1, from bytes that come one block after the other."""

    def __init__(self, state: int, depth: int):
        self.state, self.depth, self.held = state, depth, b""

    def takes(self, block: bytes, begin: bool) -> Iterator[bytes]:
        """Objects that end in this block; new ones begin only if `begin` is set."""
        data = np.frombuffer(block, np.uint8)
        steps, self.state = read_states(data, self.state)
        depth = np.cumsum(steps, dtype=np.int64) + self.depth
        own = (data == ord("{")) | (data == ord("}"))
        starts = np.flatnonzero(own & (steps == 1) & (depth == 2)) if begin else np.empty(0, np.int64)
        ends = np.flatnonzero(own & (steps == -1) & (depth == 1))
        self.depth = int(depth[-1]) if len(depth) else self.depth
        if self.held:
            if not len(ends):
                self.held += block
                return
            yield self.held + block[: ends[0] + 1]
            self.held, ends = b"", ends[1:]
        ends = ends[ends > starts[0]] if len(starts) else ends[:0]  # the first may be of an object of a range before
        for a, b in zip(starts, ends, strict=False):
            yield block[a : b + 1]
        if len(starts) > len(ends):
            self.held = block[starts[-1] :]


def as_arrays(items: DataFrame) -> DataFrame:
    """Lines of one JSON array a task of items (value: JSON text), to be written as text: a file a task, whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            lines = []
            for x in batch.column("value").to_pylist():
                lines.append(mark + x)
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if mark == "," else "[]"])], names=["value"])

    return items.mapInArrow(run, "value string")


def ranges_of(files: DataFrame, size: int) -> DataFrame:
    """path, length, k and start of each range of files (path, length)."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    rows = files.where("length > 0").select("path", "length", F.posexplode(starts).alias("k", "start"))
    return rows.select("path", F.col("k").cast("long").alias("k"), "start", "length")


def array_objects(files: DataFrame, size: int = RANGE, opener: Opener = opened) -> DataFrame:
    """path and item (JSON text) of every object that stands in the array of a file (path, length). Other files are not for this.

    Items that aren't objects are left out, and so is an object without an end. An empty file or array has none.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with opener(r["path"]) as f:
                    f.seek(r["start"])
                    data = np.frombuffer(f.read(min(size, r["length"] - r["start"])), np.uint8)
                row = r | dict(zip(("ends", "changes"), summary(data), strict=True))
                yield pa.RecordBatch.from_pylist([row], pa.schema([("path", pa.string()), ("k", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ends", pa.list_(pa.int32())), ("changes", pa.list_(pa.int64()))]))

    def composed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k", ignore_index=True)
        state, depth, states, depths = OUTSIDE, 0, [], []
        for ends, changes in zip(rows["ends"], rows["changes"], strict=True):
            states.append(state)
            depths.append(depth)
            state, depth = int(ends[state]), depth + int(changes[state])
        return pd.DataFrame({"path": rows["path"], "start": rows["start"], "length": rows["length"], "state": states, "depth": depths})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with opener(r["path"]) as f:
                    f.seek(r["start"])
                    own = Cut(r["state"], r["depth"])
                    block = f.read(min(size, r["length"] - r["start"]))
                    found = list(own.takes(block, True))
                    while own.held and (block := f.read(ONWARD)):
                        found += own.takes(block, False)
                for k in range(0, len(found), 1024):
                    items = pa.array([x.decode("utf-8", "replace") for x in found[k : k + 1024]], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(items), pa.string()), items], names=["path", "item"])

    # So many tasks: a range is a short row but much work, and Spark would put rows together by their size.
    tasks = min(MOST_TASKS, files.agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 1)
    states = ranges_of(files, size).repartition(tasks, "path", "k").mapInArrow(summed, _SUMMARY).groupBy("path").applyInPandas(composed, "path string, start long, length long, state int, depth long")
    return states.repartition(tasks, "path", "start").mapInArrow(cut, "path string, item string")


def first_characters(files: DataFrame, opener: Opener = opened) -> DataFrame:
    """path, length and first: the first character of each file that isn't white space, null if it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                with opener(path) as f:
                    rest = b""
                    while not rest and (block := f.read(ONWARD)):
                        rest = block.removeprefix(b"\xef\xbb\xbf").lstrip()
                found.append(rest[:1].decode("latin-1") or None)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], names=["path", "length", "first"])

    return files.select("path", "length").mapInArrow(run, "path string, length long, first string")
