"""Heads of audio files."""

import io
import wave
from struct import pack

import pytest

from tidemark.sources import audio


def wav(seconds, rate=8000, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(b"\0" * int(seconds * rate) * 2 * channels)
    return out.getvalue()


def mp3(kind=0b11, bits=9, rate=0, mono=False, tag=0, frames=None):
    head = pack(">I", 0x7FF << 21 | kind << 19 | 1 << 17 | 1 << 16 | bits << 12 | rate << 10 | (3 if mono else 0) << 6)
    side = (17 if mono else 32) if kind == 3 else (9 if mono else 17)
    body = head + b"\0" * side + (b"Xing" + pack(">II", 1, frames) if frames else b"") + b"\0" * 1000
    return (b"ID3\4\0\0" + bytes((tag >> 21 & 127, tag >> 14 & 127, tag >> 7 & 127, tag & 127)) + b"\0" * tag if tag else b"") + body


def test_wave():
    for seconds, rate, channels in ((1.5, 8000, 1), (0, 16000, 2), (2.25, 44100, 2)):
        got = audio.probe(wav(seconds, rate, channels)[: audio.HEAD], len(wav(seconds, rate, channels)))
        assert (got["format"], got["rate"], got["channels"]) == ("wav", rate, channels) and abs(got["duration"] - seconds) < 1e-3
    extra = wav(1)[:12] + b"LIST" + pack("<I", 3) + b"abc\0" + wav(1)[12:]  # an odd chunk is padded
    assert audio.probe(extra, len(extra))["duration"] == 1


def test_mpeg():
    assert audio.probe(mp3(), 1_600_000) == {"format": "mp3", "rate": 44100, "channels": 2, "duration": 100.0}
    assert audio.probe(mp3(mono=True, frames=1000), 5)["duration"] == 1000 * 1152 / 44100
    assert audio.probe(mp3(kind=2, bits=8, rate=2, tag=300, frames=50), 5)["duration"] == 50 * 576 / 16000
    assert audio.probe(mp3(kind=0, bits=8, rate=2, mono=True), 80_000)["rate"] == 8000
    assert audio.probe(mp3(tag=300), 310 + 16_000)["duration"] == 1.0


@pytest.mark.parametrize("head", [None, b"", b"RIFF", b"RIFF\0\0\0\0WAVEdata\0\0\0\0", wav(1)[:30], wav(1)[:-5], b"\xff\xff\xff\xff", b"ID3\4\0\0\x7f\x7f\x7f\x7f", b"<html>", wav(1).replace(pack("<I", 16000), b"\0\0\0\0")])
def test_broken(head):
    assert audio.probe(head, len(head or b""))["error"]


def test_only_good_files_are_transcribed(spark, tmp_path):
    at = f"file:{tmp_path}"
    for name, data in (("a.wav", wav(1)), ("long.wav", wav(30)), ("cut.wav", wav(1)[:-9]), ("b.mp3", mp3())):
        (tmp_path / name).write_bytes(data)
    found = audio.probed(audio.heads(spark, f"file://{tmp_path}"))
    assert {r["path"].rpartition("/")[2]: (r["format"], r["error"] is None) for r in found.collect()} == {"a.wav": ("wav", True), "long.wav": ("wav", True), "cut.wav": (None, False), "b.mp3": ("mp3", True)}
    episodes = spark.createDataFrame([(n, f"{at}/{n}") for n in ("a.wav", "long.wav", "cut.wav", "b.mp3", "gone.wav")] + [("none", None)], "episode_id string, audio_url string")

    def transcribe(url):
        assert url.endswith(("a.wav", "b.mp3"))
        return {"transcript": "words", "duration": 1.0, "language": "en"}

    from pyspark import cloudpickle

    import test_audio

    cloudpickle.register_pickle_by_value(test_audio)
    rows = {r["episode_id"]: (r["failed"], r["error"]) for r in audio.transcribed(episodes, found, transcribe, longest=20).collect()}
    assert rows["a.wav"] == rows["b.mp3"] == (False, None) and rows["long.wav"] == (True, "longer than 20 seconds") and rows["gone.wav"] == (True, "no such file") and rows["none"][1] == "no audio address"
    assert "missing" in rows["cut.wav"][1] and len(rows) == 6
