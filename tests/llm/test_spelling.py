"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import queries, spelling

SCHEMA = "doc_id long, text string"


def counts(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def wanted(rows):
    n = counts(rows)
    cut = {}
    for w in n:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            cut.setdefault(k, set()).add(w)
    form, near = {}, {}
    for w in n:
        some = set().union(*(cut.get(k, set()) for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}))
        near[w] = [x for x in some if x != w and one_edit(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_op13(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_spelling_variants"](spark, small).collect()
    assert {tuple(r) for r in got} == wanted(rows) and len(got) == len(wanted(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_made_words(spark, seed, monkeypatch):
    r = random.Random(seed)
    base = ["".join(r.choices("abéÿ", k=r.choice([5, 6, 7]))) for _ in range(60)] + ["zzzzz" * 400, "zzzzz" * 399 + "zzzzy", "aaaaa", "aaaaaa", "aaaaaaa"]
    rows = [(r.choice([None, i]), " ".join(r.choices(base, k=r.choice([0, 5, 200]))).title()) for i in range(120)] + [(1, None), (2, ""), (3, "aaaaa aaaaá AAAAA×÷")]
    rows += rows[:9]
    docs = spark.createDataFrame([(d, t, "other", 1) for d, t in rows], SCHEMA + ", word string, n int")
    want = wanted(rows)
    assert {tuple(x) for x in spelling.grouped(docs).collect()} == want and any(x[1] for x in want)
    monkeypatch.setattr(spelling, "may_be_words", lambda hashes, which, seen: which)  # the bitmap holds nothing back
    assert set(map(tuple, spelling.grouped(docs.where("length(coalesce(text, '')) < 400")).collect())) == wanted([x for x in rows if len(x[1] or "") < 400])


def test_neighbourhood_is_full():
    alphabet = np.array([97, 98, 233], np.uint64)
    every = np.full(1 << spelling.BITS - 3, 255, np.uint8)
    for word in ("a", "ab", "aabé"):
        found = spelling.neighbours([word], alphabet, every)[0]
        letters = "abé"
        want = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters} | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
        assert found == want - {word}


def test_chains_and_empty(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)], "word string, form string")
    from tidemark.llm.common import written

    assert {r["root"] for r in spelling.roots(written(forms, "forms")).collect()} == {"w40"}
    assert spelling.grouped(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.grouped(spark.createDataFrame([(1, "too few words")], SCHEMA)).collect() == []
