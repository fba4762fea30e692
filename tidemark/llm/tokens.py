"""Token ids of public tokenizers, fast enough for a corpus.

WordBpe gives the ids of a lower-casing word-level BPE file of the tokenizers library. No
piece of such a tokenizer crosses white space, so ids are looked up by space-delimited
chunk. A chunk not seen yet is merged by tiktoken's core over the same ranks, with the end
of a word as byte 0xFF. The two libraries could differ only where a merge that the file
doesn't list makes a token of it: those tokens are found beforehand, and words that hold
one go to the tokenizers library, as do texts beyond printable Latin-1 and texts that hold
the string of one of the file's special tokens, which that library makes one id.
"""

from __future__ import annotations

import base64
import json
import sys
import types
from collections.abc import Callable
from struct import pack

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Chunks that a worker remembers before it starts anew.
REMEMBERED = 250_000


def worker_cache() -> dict:
    """A dict that lasts as long as this Python process, over tasks."""
    return sys.modules.setdefault("_tidemark_worker_cache", types.ModuleType("_tidemark_worker_cache")).__dict__


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _read(path: str) -> tuple[dict[bytes, int], set[tuple[bytes, bytes]]]:
    """Ranks by bytes and the listed merges of a file; a word's end is byte 0xFF, which UTF-8 never has."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, end = _byte_letters(), model["end_of_word_suffix"]

    def raw(token: str) -> bytes:
        stem, mark = (token[: -len(end)], b"\xff") if token.endswith(end) else (token, b"")
        return bytes(letters[c] for c in stem) + mark

    ranks = {}
    for token, i in model["vocab"].items():
        stem = token.removesuffix(end)
        if stem and all(c in letters for c in stem) and not (b"\xff" in bytes(letters[c] for c in stem) and len(stem) + token.endswith(end) > 1):
            ranks[raw(token)] = i
    merges = {tuple(map(raw, x if isinstance(x, list) else x.split(" "))) for x in model["merges"]}
    merges |= {(bytes([b]), b"\xff") for b in range(255)}
    return ranks, merges


def unlisted(path: str) -> frozenset[int]:
    """Ids of the tokens that merging by rank alone can make with a merge that the file doesn't list."""
    ranks, merges = _read(path)
    found = set()
    for token, i in ranks.items():
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 1:
            best = min(((ranks[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in ranks), default=None)
            if best is None:
                found.add(i)  # only a whole-token lookup makes it
                break
            k = best[1]
            if (parts[k], parts[k + 1]) not in merges:
                found.add(i)
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return frozenset(found)


class WordBpe(dict):
    """ids(text) of a file; as a dict, what it remembers: little-endian 32-bit ids by lower-case chunk."""

    _SAFE = bytes([9, 10, 13, *range(32, 127), *range(161, 256)])

    def __init__(self, path: str, doubtful: frozenset[int]) -> None:
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks, _ = _read(path)
        self.doubtful = doubtful
        self.core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __missing__(self, chunk: str) -> bytes:
        found: list[int] = []
        for piece in self.pieces.findall(chunk):
            ids = self.core.encode_single_piece(piece.encode() + b"\xff")
            found += self.whole.encode(piece, add_special_tokens=False).ids if not self.doubtful.isdisjoint(ids) else ids
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[chunk] = pack(f"<{len(found)}I", *found)
        return out

    def ids(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of the whole text; none for a null."""
        if not text:
            return b""
        try:
            plain = not text.encode("latin-1").translate(None, self._SAFE) and not any(x in text for x in self.special)
        except UnicodeEncodeError:
            plain = False
        if not plain:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


def word_bpe(path: str, doubtful: frozenset[int]) -> WordBpe:
    """The process's own WordBpe of a file."""
    cache = worker_cache()
    if path not in cache:
        cache[path] = WordBpe(path, doubtful)
    return cache[path]


def byte_bpe(path: str) -> Callable[[str | None], np.ndarray]:
    """The process's own encoder of a file of ranks: unsigned 32-bit ids of a text, none for a null."""
    cache = worker_cache()
    if path not in cache:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache[path] = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = cache[path].encode_ordinary
    return lambda text: np.array(encode(text), "<u4") if text else np.empty(0, "<u4")
