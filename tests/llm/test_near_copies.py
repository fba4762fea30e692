"""Near copies that fingerprints miss, against all pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import near_copies as N
from tidemark.llm import prefixes as P


def sets_of(texts):
    return {i: set(N.shingles_of(t).tolist()) for i, t in enumerate(texts)}


def similar_pairs(sets):
    return {(a, b) for a, b in combinations(sets, 2) if sets[a] and len(sets[a] & sets[b]) >= N.SIMILARITY * len(sets[a] | sets[b]) - 1e-9}


def heads_of(texts):
    """The least number that links reach."""
    least, pairs, changed = {i: i for i in range(len(texts))}, similar_pairs(sets_of(texts)), True
    while changed:
        changed = False
        for a, b in pairs:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return set(least.values())


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    return {r["doc_id"] for r in N.without_near_copies(docs).collect()}


def borderline(draw, n, cuts):
    """Pairs of texts of some n words, of which the other lacks the last ones: about 0.8 and a little more."""
    texts = []
    for _ in range(cuts):
        words = [f"w{int(x)}" for x in draw.integers(0, 9000, n)]
        texts += [" ".join(words), " ".join(words[: 4 + round(0.8 * (n - 4) + 0.3)])]
    return texts


def test_no_link_is_left_out(spark):
    """Pairs at 0.8 exactly and little more, short and long: some have fingerprints too far apart, or share no key."""
    draw = np.random.default_rng(4)
    texts = [t for n in (9, 14, 19, 24, 54, 104, 304) for t in borderline(draw, n, 60)]
    assert kept(spark, texts) == heads_of(texts)


def test_no_link_is_left_out_among_look_alikes(spark):
    """Of families of 60 at 0.6 to 0.7, each text shares keys with more than SMALL; each third has a copy just over 0.8."""
    draw = np.random.default_rng(9)
    texts = []
    for family in range(3):
        words = [f"f{family}w{int(x)}" for x in draw.integers(0, 4000, 300)]
        for i in range(60):
            own = list(words)
            for k in draw.choice(50, 9, replace=False):
                own[6 * k + 2] = f"x{family}i{i}k{k}"
            texts.append(" ".join(own))
            if i % 3 == 0:
                for k in draw.choice(50, 6, replace=False):
                    own[6 * k + 2] = f"z{i}k{k}"
                texts.append(" ".join(own))
    assert kept(spark, texts) == heads_of(texts)


@pytest.mark.parametrize("tile", [16_384, 7])
def test_prefixes_hold_every_similar_pair(spark, monkeypatch, tile):
    """With and without tiles, where a common line is learned as common, and roots join some already."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "TILE", tile)
    monkeypatch.setattr(P, "FEW", 3)
    draw = np.random.default_rng(5)
    line = " ".join(f"c{i}" for i in range(30))
    texts = [f"{t} {line}" if i % 2 else t for i, t in enumerate(borderline(draw, 40, 40))]
    texts += [f"{line} e{i % 4} e{i}" for i in range(30)] + ["one", "one two", "", None]
    rows = spark.createDataFrame([(i, t, i // 3 if i > 100 else i) for i, t in enumerate(texts)], "h long, text string, root long")
    got = {(r["u"], r["v"]) for r in P.candidates(rows.select("h", "text").union(rows.select("h", "text").limit(9)), rows.select("h", "root"), N.shingles_of, N.SIMILARITY, len(texts)).collect()}
    root = {r["h"]: r["root"] for r in rows.select("h", F.col("root")).collect()}
    want = {(a, b) for a, b in similar_pairs(sets_of(texts)) if root[a] != root[b]}
    assert len(want) > 50 and want <= got and all(root[a] != root[b] for a, b in got)
    assert len(P.common_elements(rows.select("h", "text"), N.shingles_of, len(texts))) >= 26


def test_strangers_make_no_pairs(spark, monkeypatch):
    """Texts of 60 roots share twelve shingles of 116, and 40 of one root share nearly all: none is a pair."""
    monkeypatch.setattr(P, "MANY", 1000)  # no shingle is learned as common
    draw = np.random.default_rng(6)
    lines = [" ".join(f"c{k}w{i}" for i in range(5)) for k in range(12)]
    texts = []
    for _ in range(60):
        own = [f"w{int(x)}" for x in draw.integers(0, 9000, 60)]
        texts.append(" ".join(" ".join([*own[5 * k : 5 * k + 5], lines[k]]) for k in range(12)))
    texts += [f"{texts[0]} e{i}" for i in range(40)]
    rows = spark.createDataFrame([(i, t, i if i < 60 else 0) for i, t in enumerate(texts)], "h long, text string, root long")
    assert P.candidates(rows.select("h", "text"), rows.select("h", "root"), N.shingles_of, N.SIMILARITY, len(texts)).count() == 0


def test_keys_are_as_many_for_any_corpus():
    assert len({len(N.key_plan(n)[1]) for n in (0, 1_000, 10**6, 10**11)}) == 1


def test_sketches_never_differ_in_more_than_the_sets():
    """Of any lengths that one power of two is between, longest and shortest among them."""
    import pyarrow as pa

    draw = np.random.default_rng(7)
    sets = []
    for n in (1, 3, 120, 500, 520, 1_000, 1_030, 2_040, 2_060, 9_000):
        base = draw.integers(0, 1 << 63, n).astype(np.uint64)
        sets += [np.unique(np.concatenate((base[k:], draw.integers(0, 1 << 63, k).astype(np.uint64)))) for k in (0, n // 20, n // 9, n)]
    of = P._Sketches(pa.array([P.sketch(x) for x in sets], pa.binary()))
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 0.8 * max(len(sets[a]), len(sets[b])) <= min(len(sets[a]), len(sets[b]))]
    x, y = (np.array(c) for c in zip(*pairs, strict=True))
    bits = of.differing(x, y)
    apart = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in pairs])
    assert (bits <= apart).all() and (bits % 2 == apart % 2).all()
    strangers = np.array([not len(np.intersect1d(sets[a], sets[b])) and 120 < len(sets[a]) < 9_000 for a, b in pairs])
    assert strangers.sum() > 10 and (bits[strangers] > 2 * apart[strangers] / 9).all()
