"""Conversations as windows of formatted text, within a budget of tokens.

The turns of a conversation are numbered by prefix sums of their tokens. From these each window takes as many
whole turns as fit; before them stand the conversation's system turn and as many of the last turns as
HISTORY tokens hold. The loss mask covers the texts of the assistant's turns that the window has for the first
time: repeated ones are masked. A turn that alone is over the budget has a window of its own.

Rows are dealt by conversation and block of BLOCK turn numbers and pass, in order, through one function that holds the turns of
one window. A conversation over many blocks is dealt over many tasks: each of its blocks starts a window, with
the system turn and the last turns of the block before, which are sent along.

The template stands a mark before and after each role and text. Inside these a control string gets a
backslash after its first character, or one more where it has some; reading takes one away.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Tokens of a window, and those of repeated turns in it.
BUDGET, HISTORY = 1024, 256
#: Turn numbers of a block, and those at its end that the next block may repeat.
BLOCK, CARRIED = 1024, 8
#: The block of rows without a turn number, before all others.
NO_TURN = -(1 << 62)
#: Tokens that the marks of a turn take.
MARKS = 4
#: Characters of windows in a batch.
BATCH_CHARS = 8_000_000

BEGIN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Strings that a template or tokenizer may take for control. None contains the first character of another.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = re.compile("|".join(rf"(?<={re.escape(c[0])})(?=\\*{re.escape(c[1:])})" for c in CONTROL))
_UNESCAPE = re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in CONTROL))

#: block and window give the order of a conversation's windows; the first `repeated` turns of text were in an earlier one;
#: loss has the code points (begin, end) of text that are learned.
#: split is whether the conversation is over several blocks.
WINDOWS = "conv_id long, split boolean, block long, window int, text string, repeated int, turns int, tokens long, loss array<struct<begin:int,end:int>>"
#: Conversations over so many blocks or fewer are broadcast.
BROADCAST = 100_000
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escaped(text: str) -> str:
    """text with a backslash more after the first character of each control string; no mark of the template is left."""
    return _ESCAPE.sub(r"\\", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub("", text)


def tokens_of(text: Column) -> Column:
    """Tokens of a text, by words, numbers and other characters. Another count can be given to windows."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]{1,8}|[0-9]{1,3}|[^\s\p{L}\p{M}0-9]"))


def turn_rows(turns: DataFrame, tokens: Column) -> DataFrame:
    """Each turn under its block, and again under those that repeat it: kind 0 system, 1 carried, 2 own; split and head (the first block)."""
    block = F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(NO_TURN))
    rows = turns.select("conv_id", "turn", block.alias("block"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), (F.coalesce(tokens, F.lit(0)) + MARKS).cast("long").alias("tokens"))
    spans = turns.select("conv_id", "turn", block.alias("block")).groupBy(F.col("conv_id").alias("_conv")).agg(F.min(F.struct("block", "turn")).alias("first"), F.max("block").alias("last"))
    several = spans.where("first.block < last").select("_conv", "first")
    n = several.count()
    own = ["conv_id", "block", F.lit(2).alias("kind"), "turn", "role", "text", "tokens"]
    if not n:
        return rows.select(*own, F.lit(False).alias("split"), F.lit(True).alias("head"))
    several = F.broadcast(several) if n <= BROADCAST else several
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    known = rows.join(several, same, "left").withColumn("split", F.col("first").isNotNull())
    head = ~F.col("split") | (F.col("block") == F.col("first.block"))
    carried = F.col("split") & F.coalesce(F.pmod("turn", F.lit(BLOCK)) >= BLOCK - CARRIED, F.lit(False))
    to = lambda block, kind, head: F.struct(block.alias("block"), F.lit(kind).alias("kind"), head.alias("head"))
    here, onward = to(F.col("block"), 2, head), to(F.col("block") + 1, 1, F.lit(False))
    placed = known.withColumn("to", F.explode(F.when(carried, F.array(here, onward)).otherwise(F.array(here))))
    system = known.where(F.col("split") & (F.col("block") == F.col("first.block")) & F.col("turn").eqNullSafe(F.col("first.turn")) & (F.col("role") == "system")).drop("_conv", "block")
    later = rows.select("conv_id", "block").distinct().join(several, same).where(F.col("block") > F.col("first.block")).select("_conv", "block")
    return placed.select("conv_id", "to.block", "to.kind", "turn", "role", "text", "tokens", "split", "to.head").union(
        system.join(later, same).select("conv_id", "block", F.lit(0), "turn", "role", "text", "tokens", F.lit(True), F.lit(False))
    )


class Block:
    """The turns of a block as they come; gives a window when the next turn doesn't fit."""

    def __init__(self, conv_id: int | None, block: int, split: bool, head: bool):
        self.name = {"conv_id": conv_id, "split": split, "block": block}
        self.head, self.windows = head, 0
        self.system: tuple[str, str, int] | None = None
        self.system_is_new = False
        self.turns: list[tuple[str, str]] = []
        self.before = [0]  # prefix sums of the turns' tokens
        self.new = 0  # the first turn that was in no window yet

    def start(self) -> int:
        """The first turn that history has tokens for."""
        return min(self.new, bisect_left(self.before, self.before[self.new] - HISTORY))

    def takes(self, kind: int, role: str, text: str, tokens: int) -> dict | None:
        """Takes a turn; a window if that had to end first."""
        out = None
        if kind == 0 or (self.head and role == "system" and not self.system and not self.turns):
            if not self.system:
                self.system, self.system_is_new = (role, text, tokens), kind == 2
            return None
        used = self.before[-1] - self.before[self.start()] + (self.system[2] if self.system else 0)
        if kind == 2 and used + tokens > BUDGET and len(self.turns) > self.new:
            out = self.window()
        self.turns.append((role, text))
        self.before.append(self.before[-1] + tokens)
        if kind == 1:
            self.new += 1
        return out

    def window(self) -> dict | None:
        """A window of all new turns, after the system turn and history."""
        if len(self.turns) == self.new and not self.system_is_new:
            return None
        start, extra = self.start(), self.system[2] if self.system else 0
        if self.before[-1] - self.before[start] + extra > BUDGET:
            start = self.new
        shown = ([self.system[:2]] if self.system else []) + self.turns[start:]
        repeated = self.new - start + bool(self.system and not self.system_is_new)
        text, at, loss = [], 0, []
        for k, (role, said) in enumerate(shown):
            head, body = BEGIN + escaped(role) + SAYS, escaped(said)
            if k >= repeated and role == "assistant" and body:
                loss.append({"begin": at + len(head), "end": at + len(head) + len(body)})
            text += [head, body, END]
            at += len(head) + len(body) + len(END)
        out = self.name | {"window": self.windows, "text": "".join(text), "repeated": repeated, "turns": len(shown), "tokens": self.before[-1] - self.before[start] + extra, "loss": loss}
        self.windows, self.new, self.system_is_new = self.windows + 1, len(self.turns), False
        start = self.start()
        self.turns, self.before, self.new = self.turns[start:], [b - self.before[start] for b in self.before[start:]], self.new - start
        return out


def batches_of(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some BATCH_CHARS of text."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row.get("text") or "") + 200
        if chars > BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield from batch.slice(k, 256).to_pylist()


def windows(turns: DataFrame, tokens: Column | None = None) -> DataFrame:
    """WINDOWS of turns (conv_id, turn, role, text), the windows of a block in order within a partition.

    Turns of a conversation are ordered by turn (null first), then role, then text; repeated rows are repeated turns. Null texts and roles are
    empty; rows without conv_id are one conversation. The system turn is the first one, if its role is system; what is
    shown again is turns in an earlier window. tokens counts those of the column text. Further columns are left out; no rows, no windows.
    """
    tokens = tokens_of(F.col("text")) if tokens is None else tokens
    placed = turn_rows(turns.select("conv_id", "turn", "role", "text"), tokens)
    ordered = placed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")
    schema = StructType.fromDDL(WINDOWS)
    arrow = to_arrow_schema(schema)

    def formatted(rows: Iterator[dict]) -> Iterator[dict]:
        now, key = None, None
        for r in rows:
            if key != (r["conv_id"], r["block"]) or now is None:
                if now and (last := now.window()):
                    yield last
                key = r["conv_id"], r["block"]
                now = Block(*key, r["split"], r["head"])
            if done := now.takes(r["kind"], r["role"], r["text"], r["tokens"]):
                yield done
        if now and (last := now.window()):
            yield last

    return ordered.mapInArrow(lambda batches: batches_of(formatted(rows_of(batches)), arrow), schema)


def read(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    return [tuple(map(unescaped, turn.removeprefix(BEGIN).split(SAYS))) for turn in text.split(END)[:-1]]


class Digest:
    """What is read back from a conversation's windows, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def takes(self, r: dict) -> None:
        self.chars += len(r["text"])
        for role, said in read(r["text"])[r["repeated"] :]:
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for span in r["loss"]:
            learned = unescaped(r["text"][span["begin"] : span["end"]])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def digests(formatted: DataFrame) -> DataFrame:
    """DIGESTS of windows as they come from windows(): of each conversation, what its windows say.

    A conversation in one block is read where its windows are made. Only the windows of split ones go on to a
    task a conversation, which reads them one after the other, as the hash of the whole conversation asks.
    """
    both = StructType.fromDDL(f"{DIGESTS}, {WINDOWS.split(', ', 1)[1]}")
    arrow, last = to_arrow_schema(both), to_arrow_schema(StructType.fromDDL(DIGESTS))

    def digested(rows: Iterator[dict], first: bool) -> Iterator[dict]:
        now = None
        for r in rows:
            if r["split"] if first else r["text"] is None:
                yield r
                continue
            if now is None or now.conv_id != r["conv_id"]:
                if now:
                    yield now.row()
                now = Digest(r["conv_id"])
            now.takes(r)
        if now:
            yield now.row()

    some = formatted.mapInArrow(lambda batches: batches_of(digested(rows_of(batches), True), arrow), both)
    ordered = some.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return ordered.mapInArrow(lambda batches: batches_of(({c: r[c] for c in last.names} for r in digested(rows_of(batches), False)), last), DIGESTS)


def op12_budgeted_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one more whose texts look like a template, read back from their windows."""
    odd = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(windows(turns.unionByName(odd)))
