"""What an audio file's first bytes tell, so that what is broken or too long is never transcribed.

RIFF/WAVE files name their rate and size. An MPEG file's first frame has its rate and bit rate; its length is
told by a Xing or Info header if there is one, else by the file's size at that constant bit rate. Only the head of a
file is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from struct import unpack_from

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import feeds
from tidemark.sources.files import Opener, listed, opened

#: Bytes of a file that are looked at.
HEAD = 1 << 16
PROBED = "format string, rate int, channels int, duration double, error string"
#: Kilobits a second of MPEG-1 and MPEG-2 layer 3 by index, samples a second of MPEG-1, 2 and 2.5, and what marks the versions.
BIT_RATES = {1: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320), 2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)}
SAMPLES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


class Broken(ValueError):
    """A head that isn't an audio file's."""


def wave(head: bytes, length: int) -> dict:
    """Of a RIFF/WAVE file: its chunks up to the data."""
    at, form = 12, None
    while at + 8 <= len(head):
        name, size = head[at : at + 4], unpack_from("<I", head, at + 4)[0]
        if name == b"fmt " and size >= 16 and at + 24 <= len(head):
            form = unpack_from("<HHIIHH", head, at + 8)
        elif name == b"data":
            if form is None:
                raise Broken("data without a format")
            there = length - at - 8
            size = there if size in (0, 0xFFFFFFFF) else size  # streams that didn't know their size
            if size > there:
                raise Broken(f"{size - there} bytes of {size} are missing")
            if not form[3]:
                raise Broken("no bytes a second")
            return {"format": "wav", "rate": form[2], "channels": form[1], "duration": size / form[3]}
        at += 8 + size + size % 2
    raise Broken("no data")


def mpeg(head: bytes, length: int) -> dict:
    """Of an MPEG layer 3 file, behind a tag if it has one: its first frame."""
    at = 0
    if head[:3] == b"ID3" and len(head) >= 10:
        at = 10 + (head[6] << 21 | head[7] << 14 | head[8] << 7 | head[9]) + 10 * (head[5] >> 4 & 1)
    if at + 4 > len(head):
        raise Broken("no frame within the head" if at < length else "the tag is longer than the file")
    mark = unpack_from(">I", head, at)[0]
    version, layer, bits, rate, mono = mark >> 19 & 3, mark >> 17 & 3, mark >> 12 & 15, mark >> 10 & 3, mark >> 6 & 3 == 3
    if mark >> 21 != 0x7FF or version == 1 or layer != 1 or bits in (0, 15) or rate == 3:
        raise Broken("no frame")
    rate, first = SAMPLES[version][rate], version == 3
    side = (17 if mono else 32) if first else (9 if mono else 17)
    known, extra = {"format": "mp3", "rate": rate, "channels": 1 if mono else 2}, at + 4 + side
    if head[extra : extra + 4] in (b"Xing", b"Info") and extra + 12 <= len(head) and head[extra + 7] & 1:
        return known | {"duration": unpack_from(">I", head, extra + 8)[0] * (1152 if first else 576) / rate}
    return known | {"duration": (length - at) * 8 / (BIT_RATES[1 if first else 2][bits] * 1000)}


def probe(head: bytes | None, length: int | None) -> dict:
    """PROBED of a file's first bytes and its length; never raises."""
    head, length = head or b"", length or 0
    try:
        if not head:
            raise Broken("empty")
        if head[:4] == b"RIFF" and head[8:12] == b"WAVE":
            return wave(head, length)
        if head[:3] == b"ID3" or head[:1] == b"\xff":
            return mpeg(head, length)
        raise Broken("neither WAVE nor MPEG")
    except Exception as error:
        return {"error": f"{type(error).__name__}: {error}"}


def probed(heads: DataFrame) -> DataFrame:
    """path and PROBED of heads (path, head, length): what each file's first bytes tell, or an error."""
    schema = pa.schema([("path", pa.string()), ("format", pa.string()), ("rate", pa.int32()), ("channels", pa.int32()), ("duration", pa.float64()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("head").to_pylist(), batch.column("length").to_pylist(), strict=True)
            yield pa.RecordBatch.from_pylist([{"path": path} | probe(head, length) for path, head, length in rows], schema)

    return heads.select(F.col("path").cast("string").alias("path"), "head", F.col("length").cast("long").alias("length")).mapInArrow(run, f"path string, {PROBED}")


def heads(spark: SparkSession, path: str, opener: Opener = opened) -> DataFrame:
    """path, head and length of the files at path; of each only the head is read. A file that can't be opened has a null head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                some, found = batch.slice(k, 64), []
                for at in some.column("path").to_pylist():
                    try:
                        with opener(at) as f:
                            found.append(f.read(HEAD))
                    except OSError:
                        found.append(None)
                yield pa.RecordBatch.from_arrays([some.column("path"), pa.array(found, pa.binary()), some.column("length")], names=["path", "head", "length"])

    return listed(spark, path).mapInArrow(run, "path string, head binary, length long")


def transcribed(episodes: DataFrame, found: DataFrame, transcribe: Callable[[str], dict], longest: float = feeds.LONGEST_SECONDS) -> DataFrame:
    """A row of feeds.TRANSCRIPT_SCHEMA for each episode (episode_id, audio_url), by what probed() found at its address (path).

    Broken, missing and too long files are failed rows with an error, and transcribe never sees them.
    """
    known = found.select(F.col("path").alias("_path"), F.col("duration").alias("_duration"), F.col("error").alias("_error"))
    own = episodes.select("episode_id", "audio_url").join(known, F.col("audio_url") == F.col("_path"), "left")
    why = (
        F.when(F.coalesce("audio_url", F.lit("")) == "", "no audio address")
        .when(F.col("_path").isNull(), "no such file")
        .when(F.col("_error").isNotNull(), F.col("_error"))
        .when(F.col("_duration") > longest, F.lit(f"longer than {longest:g} seconds"))
    )
    judged = own.withColumn("_why", why)
    failed = judged.where("_why is not null").select("episode_id", F.lit("").alias("transcript"), F.lit(True).alias("failed"), F.col("_why").alias("error"), F.col("_duration").alias("duration"), F.lit(None).cast("string").alias("language"))
    return failed.unionByName(feeds.transcribed(judged.where("_why is null").select("episode_id", "audio_url"), transcribe, longest))
