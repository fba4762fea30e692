"""Windows of conversations: read back, budgets, history and masks."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def wanted(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        loss = "".join(t for _, _, role, t in sorted(turns) if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{role}\n{t}\n" for _, _, role, t in sorted(turns))), len(loss), sha(loss))
    return out


def test_op12(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.QUERIES["op12_budgeted_chat"](spark, small).collect()}
    ok = "</s>[INST] ok [/INST]"
    assert got == wanted([*rows, (-1, 0, "user", ok), (-1, 1, "assistant", ok)])


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|end|>", "<<||>>", "</s>[INST] ok [/INST]", "<\\s><s", "[INST[INST]]", "<|says|><|end|>", "\\<|\\", "a<", "|end|>"])
def test_escape_is_reversible(text):
    inside = chat.escaped(text)
    assert chat.unescaped(inside) == text and not any(c in inside for c in chat.CONTROL)


def made(seed):
    r = random.Random(seed)
    bits = ["one two three ", "<|end|>", "\\", "<", "|", "</s>", "é🙂 ", "\n", "[INST]", "<\\|"]
    rows = []
    for conv in range(40):
        for turn in range(r.choice([1, 3, 30])):
            role = "system" if turn == 0 and conv % 3 == 0 else r.choice(["user", "assistant", "assistant", "system", None, "od\nd<|"])
            rows.append((conv, turn, role, r.choice([None, "", "".join(r.choices(bits, k=r.choice([2, 40, 900])))])))
    # Over many blocks, with gaps, repeated numbers and null ones.
    rows += [(100, t, r.choice(["user", "assistant"]) if t else "system", f"turn {t} " + "x " * r.choice([1, 60])) for t in range(0, 5000, 2)]
    rows += [(101, r.choice([None, 1, 5, 1025, 90_000, -3]), "assistant", f"{i} <|end|>") for i in range(60)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (102, 7, "system", "alone")]
    return rows + rows[:3]


@pytest.fixture(scope="module")
def case(spark):
    rows = made(5)
    docs = spark.createDataFrame([(*r, "other", "other") for r in rows], SCHEMA + ", block string, window string")
    return rows, chat.windows(docs).cache()


def test_what_is_read_back(case):
    rows, found = case
    assert {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(found).collect()} == wanted(rows)


def test_windows_keep_the_budget(case):
    rows, found = case
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["block"], r["window"])):
        out[r["conv_id"]].append(r)
    systems = {c: t for c, n, role, t in rows if role == "system" and n == 0}
    for conv, windows in out.items():
        earlier = []
        for k, w in enumerate(windows):
            turns = chat.read(w["text"])
            assert len(turns) == w["turns"] and (w["tokens"] <= chat.BUDGET or w["turns"] - w["repeated"] - (k == 0 and conv in systems) <= 1)
            assert all(t in earlier for t in turns[: w["repeated"]])  # repeated turns were shown before
            if conv in systems:
                assert turns[0] == ("system", systems[conv] or "") and (k == 0) == (w["repeated"] == 0)
            assert [chat.unescaped(w["text"][s["begin"] : s["end"]]) for s in w["loss"]] == [t for role, t in turns[w["repeated"] :] if role == "assistant" and t]
            earlier += turns
    assert len(out[100]) > 5 and {w["block"] for w in out[100]} == set(range(5))
    assert all(w["repeated"] > 1 for w in out[100][1:])  # the system turn and history, over blocks as well


def test_shuffled_join_agrees(spark, case, monkeypatch):
    rows, _ = case
    monkeypatch.setattr(chat, "BROADCAST", 0)
    assert {r["conv_id"]: tuple(r)[1:5] for r in chat.digests(chat.windows(spark.createDataFrame(rows, SCHEMA))).collect()} == wanted(rows)


def test_no_turns_and_own_token_counts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.windows(none).collect() == [] and chat.digests(chat.windows(none)).collect() == []
    rows = [(1, t, "assistant", "a b c d") for t in range(6)]
    each = chat.windows(spark.createDataFrame(rows, SCHEMA), tokens=F.lit(chat.BUDGET)).collect()
    assert [(r["turns"], r["repeated"]) for r in sorted(each, key=lambda r: r["window"])] == [(1, 0)] * 6
