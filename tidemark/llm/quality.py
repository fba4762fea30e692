"""Quality rules of documents and of their hosts.

Rules are measured on whole texts. Failures are summed by host, and each host's rate is shrunk
towards the rate of all hosts by a beta prior fitted to the hosts themselves. By that rate a host is, for each rule, one of three:

* good, if it is under TOLERATED, where failures are accidents, or SPREAD of the prior's deviations under the
  prior's mean: its documents' failures are excused;
* bad, if it is over TOLERATED and SPREAD deviations over the mean: its documents fall by a mere slip in the rule;
* else like other hosts: its documents fall by a failure of their own.

A document falls by the base rules whatever its host is. Where hosts are alike, the rules of documents stand as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import map_batches, private, written

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: A shrunk rate of failures up to this is good, whatever other hosts' are.
TOLERATED = 0.02
#: How many of the prior's standard deviations part good and bad hosts from its mean.
SPREAD = 2.0
#: Bounds of the prior's weight, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 10_000.0
#: Verdicts of at most so many hosts are broadcast; of more, joined by salted keys.
BROADCAST_HOSTS, SALTS = 50_000, 32

FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more, the first one included."""
    n = len(words)
    if n <= window:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    code, kinds = ids, len(number)
    for k in range(1, window):
        if kinds * len(number) >= 1 << 62:  # renumber, so that codes stay exact
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            kinds = int(code.max()) + 1
        code = code[: n - k] * len(number) + ids[k:]
        kinds *= len(number)
    ordered = np.sort(code)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(np.isin(code, again))
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:n])))


def facts_of(text: str | None) -> tuple[int, ...]:
    """The figures named in FACTS, over the whole text; zeros for a null."""
    if not text:
        return (0,) * len(FACTS)
    data = text.encode()
    words = data.split()  # by exactly the six white space characters
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(b"".join(words).decode()), len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


def measured(docs: DataFrame) -> DataFrame:
    """docs with the figures of FACTS (long). Columns of those names give way."""
    kept = docs.drop(*FACTS)
    schema = StructType([*kept.schema.fields, *(StructField(c, LongType()) for c in FACTS)])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            found = np.array([facts_of(x) for x in batch.column("text").to_pylist()], np.int64).reshape(-1, len(FACTS))
            return {c: batch.column(c) for c in batch.schema.names} | {c: pa.array(found[:, i]) for i, c in enumerate(FACTS)}

        return step

    return map_batches(kept, make, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Failures by rule, which the base lacks; each is false for a text without words."""
    n = F.col("n_words")
    return {
        "symbols": 100 * F.col("n_symbols") > 25 * n,
        "same_lines": (F.col("n_dup_lines") >= 3) & (F.col("n_dup_lines") * 20 > n),
        "word_length": (n > 0) & ((F.col("word_chars") < 3 * n) | (F.col("word_chars") > 14 * n)),
    }


def slips() -> dict[str, Column]:
    """Slips by rule: what a bad host's documents fall by. Every failure is a slip."""
    n = F.col("n_words")
    return {
        "symbols": 100 * F.col("n_symbols") > 10 * n,
        "same_lines": (F.col("n_dup_lines") >= 1) & (F.col("n_dup_lines") * 40 > n),
        "word_length": (n > 0) & ((2 * F.col("word_chars") < 7 * n) | (F.col("word_chars") > 12 * n)),
    }


#: Rules on which hosts are judged.
HOST_RULES = ("symbols", "same_lines", "word_length")


def host_verdicts(failures: DataFrame, tolerated: float = TOLERATED, spread: float = SPREAD) -> DataFrame:
    """Hosts that are not good in every rule, from the columns host and fails_<rule>: host, and for each rule fails_<rule> (not
    good) and bad_<rule>. Null hosts get no verdict.

    The prior of a rule is the beta distribution whose mean is the rate of all documents and
    whose variance is that between hosts less what sampling explains.
    """
    known = failures.where(F.col("host").isNotNull())
    hosts = written(known.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col(f"fails_{r}").cast("long")).alias(r) for r in HOST_RULES)), "hosts")
    sums = hosts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), *(F.sum(r).alias(r) for r in HOST_RULES), *(F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_squares") for r in HOST_RULES)).first()
    total, verdicts = sums["n"] or 0, []
    for r in HOST_RULES:
        mean = sums[r] / total if total else 0.0
        sampling = mean * (1 - mean) * sums["hosts"] / total if total else 0.0
        between = (sums[f"{r}_squares"] / total - mean * mean if total else 0.0) - sampling
        weight = min(PRIOR_MOST, max(PRIOR_LEAST, mean * (1 - mean) / between - 1)) if between > 0 else PRIOR_MOST
        deviation = (mean * (1 - mean) / (weight + 1)) ** 0.5
        rate = (F.col(r) + F.lit(weight * mean)) / (F.col("n") + F.lit(weight))
        verdicts += [(rate > max(tolerated, mean - spread * deviation)).alias(f"fails_{r}"), (rate > max(tolerated, mean + spread * deviation)).alias(f"bad_{r}")]
    return hosts.select("host", *verdicts).where(F.greatest(*(F.col(f"fails_{r}") for r in HOST_RULES)))


def judged(docs: DataFrame, host: str = "source", drop_text: bool = False, tolerated: float = TOLERATED, spread: float = SPREAD) -> DataFrame:
    """docs with FACTS, base_failed and kept; without their text if drop_text.

    A null or empty text has no words and falls as too short. A null host has no verdict.
    Repeated rows are judged alike and all stay. An empty table gives no rows. Columns of
    docs named as the results give way; all other extra columns stay.
    """
    docs = docs.drop("base_failed", "kept")
    own_host, fails, verdict, salt, salt_of = private(docs, "_host", "_fails", "_verdict", "_salt", "_salt_of")
    own = [c.alias(f"fails_{r}") for r, c in rules().items()] + [c.alias(f"slips_{r}") for r, c in slips().items()]
    facts = measured(docs).withColumn(fails, F.struct(*own))
    if drop_text:
        facts = written(facts.drop("text"), "facts")
    # else rules are measured once for the hosts and once more here: cheaper than another copy of all texts
    bad = written(host_verdicts(facts.select(F.col(host).alias("host"), *(f"{fails}.fails_{r}" for r in HOST_RULES)), tolerated, spread), "bad_hosts")
    bad = bad.select(F.col("host").alias(own_host), F.struct(*(f"{x}_{r}" for r in HOST_RULES for x in ("fails", "bad"))).alias(verdict))
    if bad.count() <= BROADCAST_HOSTS:
        joined = facts.join(F.broadcast(bad), F.col(host) == F.col(own_host), "left")
    else:
        dealt = facts.withColumn(salt_of, F.pmod(F.xxhash64("doc_id", *FACTS), F.lit(SALTS)))
        repeated = bad.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = dealt.join(repeated, (F.col(host) == F.col(own_host)) & (F.col(salt_of) == F.col(salt)), "left")
    by_host = lambda text, host: [F.col(f"{fails}.{text}_{r}") & F.coalesce(F.col(f"{verdict}.{host}_{r}"), F.lit(False)) for r in HOST_RULES]
    fallen = F.greatest(*by_host("fails", "fails"), *by_host("slips", "bad"))
    out = joined.withColumns({"base_failed": base_failed(), "kept": ~(base_failed() | fallen)})
    return out.drop(own_host, fails, verdict, salt, salt_of)


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of judged; nulls, empty texts, repeated rows and empty tables as there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return judged(docs, drop_text=True).select("doc_id", *FACTS, "base_failed", "kept")
