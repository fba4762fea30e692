"""Cases of the first review's findings."""

from collections import Counter

import numpy as np
import pytest


def test_every_word_is_trained_on(spark):
    from tidemark.llm import scoring as S

    docs = spark.range(20_000).selectExpr("id AS doc_id", "'one two three four five six seven eight' AS text")
    scored = S.pseudo_likelihood(docs).agg({"mean_log_prob": "avg"}).first()[0]
    assert scored > -1  # trained on first words alone, the others are unlikely everywhere
    texts = [np.arange(1, n, dtype=np.uint16).tobytes() for n in (9, 2, 40, 1, 30)]
    windows = [S.windows_of(S.padded(texts), k) for k in range(S.ROUNDS)]
    assert sorted(np.concatenate(windows)[:, S.REACH].tolist()) == sorted(x for n in (9, 2, 40, 30) for x in range(1, n))


@pytest.mark.parametrize("known", [300_000, 40])
def test_words_of_one_leaf_score_apart(spark, monkeypatch, known):
    from tidemark.llm import scoring as S

    monkeypatch.setattr(S, "broadcast_shares", lambda rare, f=S.broadcast_shares: f(rare, known))
    names = [f"w{i}" for i in range(20_000)]
    same = [w for w in names if S.xxhash.xxh64_intdigest(w.encode()) % S.BUCKETS == 5]
    often, rare = same[:2]
    texts = [f"c{i % 191}" for i in range(191 * 30)] + [often] * 10 + [rare, f"c1 {often} c2", f"c1 {rare} c2"] + names
    rows = S.pseudo_likelihood(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by = {texts[r["doc_id"]]: r["log_likelihood"] for r in rows}
    counts = Counter(w for t in texts for w in t.split())
    assert by[f"c1 {often} c2"] - by[f"c1 {rare} c2"] == pytest.approx(np.log((counts[often] + S.SMOOTH) / (counts[rare] + S.SMOOTH)), abs=1e-4)


def test_discovered_identifiers_admit_patterns(spark):
    from tidemark.llm import pii

    # mail addresses name "badge no"; the badges found there name "pass key", where no address stands
    texts = [f"badge no user{i}@site.org now" for i in range(40)] + [f"badge no ab-{i}1234 now" for i in range(8)]
    texts += [f"pass key ab-{i}1234 then" for i in range(8)] + ["pass key zz-98765 then", "other word qq-98765 then"]
    rows = pii.spanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {texts[r["doc_id"]] for r in rows if any(x["kind"] == pii.CONTEXT for x in r["spans"])}
    assert found == set(texts[40:-1])


def test_scores_hang_on_the_rows_alone(spark, small, monkeypatch):
    """The same scores however rows are cut into files and tasks, with several trainers."""
    from tidemark.llm import scoring as S

    monkeypatch.setattr(S, "LEAST_WORDS", 10_000)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    again = docs.union(docs.limit(5))
    found = []
    for parts, files in ((1, "128m"), (7, "4k")):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", files)
        try:
            rows = S.pseudo_likelihood(again.repartition(parts, "text")).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        found.append(sorted((r["doc_id"], r["n_tokens"], r["mean_log_prob"] or 0.0) for r in rows))
    assert S.trainers_of(sum(r[1] for r in found[0])) == S.TRAINERS
    assert [x[:2] for x in found[0]] == [x[:2] for x in found[1]]
    assert np.allclose([x[2] for x in found[0]], [x[2] for x in found[1]], atol=1e-6, rtol=0)


def test_context_says_more_than_shares(spark, small):
    """On a tenth that wasn't trained on, the network's log-probability is above that of the words' shares alone."""
    from tidemark.llm import scoring as S
    from tidemark.llm.common import written

    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    words = S.vocabulary(S.word_counts(docs))
    common = [w for w, _ in words]
    tree = S.Tree(np.concatenate((np.array([n for _, n in words], float), np.full(S.BUCKETS, 100.0))))
    texts = written(S.numbered(docs, common, np.zeros(0, np.int64), np.zeros(0, np.int64), ["doc_id"]), "held_out_of_a_test")
    held = [r["ids"] for r in texts.where("doc_id % 10 = 3").collect()]
    ids = S.padded([bytes(x) for x in held])
    mean = lambda net: float(S.score(net, tree, ids)[ids[S.REACH : len(ids) - S.REACH] > 0].mean())
    gain = mean(S.trained(texts.where("doc_id % 10 <> 3"), tree)) - mean(S.Network(tree))
    print(f"gain of held-out log-probability: {gain:.3f}")
    assert gain > 0.2
