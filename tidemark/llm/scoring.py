"""Language-model scores by masked pseudo-likelihood.

A small network sees the REACH words on either side of a hidden word and predicts the word. Its output is a
Huffman tree over the vocabulary: a word's probability is the product of the decisions on
its path, so that probabilities of all words sum to one and a prediction costs as many steps as the path
has. The vocabulary grows with the corpus, up to WORDS words of LEAST occurrences or more; other words
share BUCKETS leaves by hash, and within its leaf a word has its smoothed share of the leaf's occurrences,
from exact counts of all words of the corpus. A document's score is the sum over its words of the
log-probability of each given both sides.

The network is trained in numpy on every word of every document, each in one of the rounds. Runs of
words are dealt to trainers; in each round they start from the same weights and pass the round's windows
in small batches. Each row of weights then moves by the mean of the trainers' moves, weighted by how often each
trainer met it. Runs are sorted, and moves are summed as integers, so that the weights don't hang on the order
in which tasks end, or on tasks that run again.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import discarded, map_batches, written

#: Words of the vocabulary at most, their least count, and the leaves that all other words share. Ids fit 16 bits.
WORDS, LEAST, BUCKETS = 1 << 15, 20, 1 << 10
REACH, HIDDEN, TOP = 2, 8, 15
ROUNDS, BATCH, RATE, SEED = 2, 4096, 0.1, 6
#: Trainers of a corpus of TRAINERS times LEAST_WORDS words; below that each has LEAST_WORDS or more, and above it TRAINER_WORDS at most, about.
TRAINERS, LEAST_WORDS, TRAINER_WORDS = 6, 1_000_000, 8_000_000
#: Words whose windows are shuffled together, at least.
RUN = 250_000
#: Distinct words that a task counts before it passes them on, and that it remembers.
HELD = 300_000
#: Words whose shares are broadcast, at most; any other's is joined by its hash.
KNOWN = 300_000
#: Added to each count of a leaf's words, and the count of a word that isn't among them.
SMOOTH = 0.5
#: Moves are summed in units of 1 / UNIT, in chunks of so many numbers.
UNIT, CHUNK = 1 << 16, 1 << 14
#: Words that are scored at once.
AT_ONCE = 4096
PLACES = tuple(k for k in range(-REACH, REACH + 1) if k)


def words_of(text: str | None) -> list[bytes]:
    """Words between the six white space characters, A-Z in lower case."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary) and n over all of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(words_of(text))
                if len(counts) > HELD:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, most: int = WORDS, least: int = LEAST) -> list[tuple[bytes, int]]:
    """The commonest words of word_counts with their counts, equal counts by bytes: `most` at most."""
    return [(bytes(r["word"]), r["n"]) for r in counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).collect()]


def word_hash(word: bytes) -> int:
    x = xxhash.xxh64_intdigest(word)
    return x - (1 << 64) if x >> 63 else x


def rare_words(counts: DataFrame, common: list[bytes]) -> DataFrame:
    """hash, n and bucket of the words that aren't common; a table."""

    def make():
        known = set(common)

        def step(batch: pa.RecordBatch) -> dict:
            rows = [(word_hash(w), n) for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True) if w not in known]
            return {"hash": [h for h, _ in rows], "n": [n for _, n in rows]}

        return step

    return written(map_batches(counts, make, "hash long, n long").withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)).cast("int")), "rare_words")


def bucket_sums(rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences and words of each bucket."""
    n, words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rare.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        n[r["bucket"]], words[r["bucket"]] = r["n"], r["words"]
    return n, words


def word_shares(rare: DataFrame, sums: np.ndarray) -> DataFrame:
    """hash, n and share (log, in units of 1e-9) of the words that aren't common. sums: by bucket, of smoothed counts.
    All words scored are of the corpus; what an unseen one would have is left free in each bucket."""
    of = F.element_at(F.array(*(F.lit(float(x)) for x in sums)), F.col("bucket") + 1)
    return rare.select("hash", "n", F.round(F.log((F.col("n") + SMOOTH) / of) * 1e9).cast("long").alias("share"))


def broadcast_shares(rare: DataFrame, most: int = KNOWN) -> tuple[int, np.ndarray, np.ndarray]:
    """The least count whose words, with all of greater counts, are at most so many; their hashes and shares."""
    least, held = 0, 0
    for r in rare.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        held += r["words"]
        if held > most:
            least = r["n"] + 1
            break
    table = rare.where(F.col("n") >= least).select("hash", "share").toArrow()
    return least, table["hash"].to_numpy(), table["share"].to_numpy()


class Tree:
    """A Huffman tree: the inner nodes on each id's path from the root, the most met first, the side it takes at each,
    and how often each node is met. Id 0 stands outside a document; it is never predicted and has no path.

    Steps through the TOP most met nodes are in a matrix (0 where a path doesn't pass); the others by depth.
    """

    def __init__(self, counts: np.ndarray) -> None:
        n = len(counts)
        inner, total = max(1, n - 1), max(1.0, float(counts.sum()))
        heap = [(float(c), i) for i, c in enumerate(counts.tolist())]
        heapq.heapify(heap)
        up, side, met, bias = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int8), np.zeros(inner), np.zeros(inner, np.float32)
        for k in range(n - 1):  # nodes come with growing counts
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            up[[i, j]], side[[i, j]] = n + k, (-1, 1)
            met[n - 2 - k], bias[n - 2 - k] = a + b, np.log((b + SMOOTH) / (a + SMOOTH))
            heapq.heappush(heap, (a + b, n + k))
        self.nodes, self.frequency, self.met, self.bias = n - 1, np.concatenate(([0], counts)) / total, met / total, bias
        self.top = np.zeros((n + 1, min(TOP, inner)), np.float32)
        deep: list[list[tuple[int, int]]] = [[]]
        for i in range(n):
            path, at = [], i
            while at != 2 * n - 2:
                node, own = 2 * n - 2 - int(up[at]), int(side[at])
                if node < TOP:
                    self.top[i + 1, node] = own
                else:
                    path.append((node, own))
                at = int(up[at])
            deep.append(path)
        self.depth = np.array([len(x) for x in deep], np.uint8)
        most = int(self.depth.max(initial=0))
        self.deep = np.zeros((most, n + 1), np.int32)  # nodes, counted from 1, with their sides as signs
        for i, path in enumerate(deep):
            for k, (node, own) in enumerate(path):
                self.deep[k, i] = own * (node + 1)

    @classmethod
    def of(cls, state: dict) -> Tree:
        """The tree of another's __dict__; plain arrays are what can be broadcast to workers without this package."""
        tree = cls.__new__(cls)
        tree.__dict__.update(state)
        return tree

    def times_met(self, hidden: np.ndarray) -> np.ndarray:
        """How often each node is met, where each id is predicted so often."""
        out = np.zeros(max(1, self.nodes), np.int64)
        out[: self.top.shape[1]] = np.rint(hidden @ np.abs(self.top).astype(np.float64))
        for steps in self.deep:
            out += np.bincount(np.maximum(np.abs(steps) - 1, 0), hidden * (steps != 0), len(out)).astype(np.int64)
        return out

    def by_depth(self, ids: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """An order of ids by falling depth, and how many have a step at each depth."""
        depth = self.depth[ids]
        order = np.argsort(255 - depth, kind="stable")
        counts = np.cumsum(np.bincount(depth, minlength=len(self.deep) + 1)[::-1])[::-1][1:].tolist()
        return order, [m for m in counts if m]

    def deep_steps(self, ids: np.ndarray, counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of ids in that order: nodes and sides of the steps at each depth in turn."""
        steps = np.concatenate([self.deep[k].take(ids[:m]) for k, m in enumerate(counts)])
        return np.abs(steps) - 1, np.sign(steps).astype(np.float32)


class Network:
    """Weights: a row for each place and id, the hidden units' bias, and a row with a bias for each node of the tree."""

    def __init__(self, tree: Tree) -> None:
        draw, n = np.random.default_rng(SEED), len(tree.depth)
        self.into = draw.normal(0, 0.2, (len(PLACES) * n, HIDDEN)).astype(np.float32)
        self.hidden = np.zeros((1, HIDDEN), np.float32)
        self.out = np.zeros((len(tree.bias), HIDDEN), np.float32)
        self.out_bias = tree.bias[:, None].copy()  # without the sides, words have their shares of the corpus
        self.ids = n

    def parts(self) -> list[np.ndarray]:
        return [self.into, self.hidden, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    def load(self, x: np.ndarray) -> Network:
        at = 0
        for part in self.parts():
            part[...] = x[at : at + part.size].reshape(part.shape)
            at += part.size
        return self

    def units(self, around: np.ndarray) -> np.ndarray:
        """Hidden units for rows of the ids around."""
        h = self.into.take(around[:, 0], axis=0)
        for k in range(1, len(PLACES)):
            h += self.into.take(around[:, k] + k * self.ids, axis=0)
        h += self.hidden
        return np.tanh(h, out=h)


def _log_sigmoid(z: np.ndarray) -> np.ndarray:
    return np.minimum(z, 0) - np.log(1 + np.exp(-np.abs(z)))


def log_probs(net: Network, tree: Tree, around: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """Log-probabilities of the hidden ids for rows of the ids around."""
    if not tree.nodes:  # a single word is sure
        return np.zeros(len(hidden), np.float32)
    order, counts = tree.by_depth(hidden)
    ids, h = hidden[order], net.units(around[order])
    top, n = tree.top.take(ids, axis=0), tree.top.shape[1]
    z = (h @ net.out[:n].T + net.out_bias[:n, 0]) * top
    logs = (_log_sigmoid(z) * np.abs(top)).sum(axis=1)
    if counts:
        nodes, side = tree.deep_steps(ids, counts)
        z = np.einsum("ij,ij->i", net.out.take(nodes, axis=0), np.concatenate([h[:m] for m in counts])) + net.out_bias[:, 0].take(nodes)
        deep, at = _log_sigmoid(z * side), 0
        for m in counts:
            logs[:m] += deep[at : at + m]
            at += m
    out = np.empty(len(hidden), np.float32)
    out[order] = logs
    return out


def _subtract(rows: np.ndarray, at: np.ndarray, moves: np.ndarray) -> None:
    """rows[at] -= moves, where at may repeat: by pairs of numbers, which numpy adds in one step."""
    pairs = np.arange(HIDDEN // 2)
    np.subtract.at(rows.view(np.complex64).reshape(-1), (at[:, None] * np.intp(HIDDEN // 2) + pairs).reshape(-1), moves.view(np.complex64).reshape(-1))


def train(net: Network, tree: Tree, windows: np.ndarray, rate: float = RATE) -> None:
    """One pass of gradient steps over windows (ids of each place, the hidden word in the middle). A row of weights that
    a batch meets often takes shorter steps."""
    if not tree.nodes:
        return
    node_rate = (rate / np.sqrt(1 + BATCH * tree.met)).astype(np.float32)
    word_rate = (rate / np.sqrt(1 + BATCH * tree.frequency)).astype(np.float32)
    word_rate[0] = rate / BATCH**0.5  # outside a document
    with np.errstate(over="ignore"):  # the inverse of infinity is the limit
        for k in range(0, len(windows), BATCH):
            _step(net, tree, windows[k : k + BATCH], rate, node_rate, word_rate)


def _step(net: Network, tree: Tree, rows: np.ndarray, rate: float, node_rate: np.ndarray, word_rate: np.ndarray) -> None:
    n, out_bias = tree.top.shape[1], net.out_bias.reshape(-1)
    order, counts = tree.by_depth(rows[:, REACH])
    rows = rows[order].astype(np.int64)
    ids, around = rows[:, REACH], np.delete(rows, REACH, axis=1)
    h = net.units(around)
    sides = tree.top.take(ids, axis=0)
    z = (h @ net.out[:n].T + out_bias[:n]) * sides
    g = -sides / (1 + np.exp(z))
    dh = g @ net.out[:n]
    g *= node_rate[:n]
    net.out[:n] -= g.T @ h
    out_bias[:n] -= g.sum(axis=0)
    if counts:
        nodes, side = tree.deep_steps(ids, counts)
        o, repeated = net.out.take(nodes, axis=0), np.concatenate([h[:m] for m in counts])
        z = np.einsum("ij,ij->i", o, repeated) + out_bias.take(nodes)
        g = -side / (1 + np.exp(z * side))
        o *= g[:, None]
        at = 0
        for m in counts:
            dh[:m] += o[at : at + m]
            at += m
        g *= node_rate.take(nodes)
        repeated *= g[:, None]
        _subtract(net.out, nodes, repeated)
        np.subtract.at(out_bias, nodes, g)
    dh *= 1 - h * h
    net.hidden -= rate / BATCH * dh.sum(axis=0)
    for p in range(len(PLACES)):
        _subtract(net.into, around[:, p] + p * net.ids, dh * word_rate.take(around[:, p])[:, None])


class Ids(dict):
    """Of a word its id and, above that, the log of its share of its leaf in units of 1e-9, or MISSING where that isn't
    broadcast; remembers up to HELD of the words that aren't common."""

    MISSING = 1

    def __init__(self, common: list[bytes], hashes: np.ndarray, shares: np.ndarray) -> None:
        super().__init__()
        self.common = {w: 1 + i for i, w in enumerate(common)}
        self.known = dict(zip(hashes.tolist(), shares.tolist(), strict=True))
        self.update(self.common)

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
            self.update(self.common)
        x = word_hash(word)
        found = self[word] = (self.known.get(x, self.MISSING) << 16) + 1 + len(self.common) + x % BUCKETS
        return found

    def of(self, words: list[bytes]) -> tuple[np.ndarray, int, list[int]]:
        """Ids of words, the sum of the shares that are known, and the hashes of all other words."""
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        shares = found >> 16
        others = np.flatnonzero(shares == self.MISSING)
        return (found & 0xFFFF).astype(np.uint16), int(shares.sum()) - self.MISSING * len(others), [word_hash(words[i]) for i in others.tolist()]


def numbered(docs: DataFrame, common: list[bytes], hashes: np.ndarray, shares: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns keep of docs with ids (two bytes each), known (the sum of the shares that are broadcast) and others
    (hashes of the words whose shares aren't)."""
    shipped = docs.sparkSession.sparkContext.broadcast((common, hashes, shares))

    def make():
        ids = Ids(*shipped.value)

        def step(batch: pa.RecordBatch) -> dict:
            found = [ids.of(words_of(x)) for x in batch.column("text").to_pylist()]
            return {c: batch.column(c) for c in keep} | {"ids": [x.tobytes() for x, _, _ in found], "known": [x for _, x, _ in found], "others": [x for _, _, x in found]}

        return step

    schema = StructType([*(docs.schema[c] for c in keep), *StructType.fromDDL("ids binary, known long, others array<long>")])
    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), make, schema)


def padded(texts: list[bytes]) -> np.ndarray:
    """The ids of texts in one run, each with REACH zeros on either side."""
    gap = np.zeros(REACH, np.uint16)
    return np.concatenate([gap, *(x for t in texts for x in (np.frombuffer(t, np.uint16), gap, gap))])


def windows_of(ids: np.ndarray, number: int, rounds: int = ROUNDS) -> np.ndarray:
    """The windows of a padded run that a round trains on: over all rounds, each word is in the middle of one."""
    middle = np.flatnonzero(ids)[number::rounds]
    return ids[middle[:, None] + np.arange(-REACH, REACH + 1)]


def _moves(net: Network, before: np.ndarray, windows_seen: np.ndarray, nodes_seen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of weights, how often it was met and, so weighted, how far it moved, in units."""
    met = [windows_seen.ravel(), np.array([n], np.int64), nodes_seen, nodes_seen]
    moved = net.flat().astype(np.float64) - before
    weight = np.concatenate([np.repeat(m, part.shape[1]) for m, part in zip(met, net.parts(), strict=True)])
    return np.concatenate(met), np.rint(moved * weight * UNIT).astype(np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each chunk's numbers; a task holds as many as there are weights at most."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data"), strict=True):
            x = np.frombuffer(data.as_py(), np.int64)
            sums[chunk] = sums[chunk] + x if chunk in sums else x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["chunk", "data"])


def _by_trainer(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[bytes]]:
    """The texts' ids of each trainer in turn, from rows in the trainers' order."""
    rows = ((t, x.as_py()) for batch in batches for t, x in zip(batch.column("trainer").to_pylist(), batch.column("ids"), strict=True))
    for _, own in groupby(rows, key=itemgetter(0)):
        yield (x for _, x in own)


def _runs(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """Padded runs of RUN words or more, but for the last one."""
    held, n = [], 0
    for x in texts:
        held.append(x)
        n += len(x) // 2
        if n >= RUN:
            yield padded(held)
            held, n = [], 0
    if held:
        yield padded(held)


def trainers_of(words: int) -> int:
    """How many trainers share so many words."""
    return max(1, min(TRAINERS, words // LEAST_WORDS), -(-words // TRAINER_WORDS))


def trained(texts: DataFrame, tree: Tree, rounds: int = ROUNDS) -> Network:
    """The network after some rounds over the columns doc_id and ids. Without any word it stays as it was drawn.

    Which trainer has a text, and in which order, hangs on doc_id and ids alone, not on how tables are cut into files or tasks.
    """
    spark, net = texts.sparkSession, Network(tree)
    known = texts.where(F.octet_length("ids") > 0).select("ids", F.xxhash64("doc_id", "ids").alias("h"))  # copies go to many trainers
    total = known.agg(F.sum(F.octet_length("ids") / 2)).first()[0] or 0
    if not total:
        return net
    trainers = trainers_of(int(total))
    # Names of trainers that Spark's hash deals to a task each; a task of two would only take longer.
    tasks = spark.range(64 * trainers).select(F.col("id").cast("int").alias("name")).withColumn("task", F.pmod(F.hash("name"), F.lit(trainers)))
    names = [r["name"] for r in tasks.groupBy("task").agg(F.min("name").alias("name")).orderBy("task").collect()]
    dealt = known.withColumn("trainer", F.element_at(F.array(*map(F.lit, names)), F.pmod("h", F.lit(len(names))).cast("int") + 1)).repartition(trainers, "trainer").sortWithinPartitions("trainer", "h", "ids")
    shipped_tree = spark.sparkContext.broadcast(tree.__dict__)
    rows = sum(len(x) for x in net.parts())
    for number in range(rounds):
        shipped = spark.sparkContext.broadcast(net.flat())
        rate = RATE / (1 + number)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped, number=number, rate=rate) -> Iterator[pa.RecordBatch]:
            own_tree, before = Tree.of(shipped_tree.value), shipped.value
            for own_texts in _by_trainer(batches):
                own, seen = Network(own_tree).load(before), 0
                around = np.zeros((len(PLACES), own.ids), np.int64)
                hidden = np.zeros(own.ids, np.int64)
                for ids in _runs(own_texts):
                    windows = windows_of(ids, number, rounds)
                    train(own, own_tree, windows[np.random.default_rng(len(windows)).permutation(len(windows))], rate)
                    for p, k in enumerate(PLACES):
                        around[p] += np.bincount(windows[:, REACH + k], minlength=own.ids)
                    hidden += np.bincount(windows[:, REACH], minlength=own.ids)
                    seen += len(windows)
                if seen:
                    nodes = own_tree.times_met(hidden)
                    data = np.concatenate(_moves(own, before, around, nodes, seen))
                    for c, k in enumerate(range(0, len(data), CHUNK)):
                        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([data[k : k + CHUNK].tobytes()], pa.binary())], names=["chunk", "data"])

        moves = dealt.mapInArrow(run, "chunk int, data binary")
        sums = moves.repartition("chunk").mapInArrow(_added, "chunk int, data binary").collect()  # as many numbers as weights and rows
        data = np.concatenate([np.frombuffer(r["data"], np.int64) for r in sorted(sums, key=lambda r: r["chunk"])])
        met = np.maximum(data[:rows], 1)
        weight = np.concatenate([np.repeat(m, part.shape[1]) for m, part in zip(np.split(met, np.cumsum([len(x) for x in net.parts()])[:-1]), net.parts(), strict=True)])
        net.load((net.flat() + data[rows:] / UNIT / weight).astype(np.float32))
    return net


def score(net: Network, tree: Tree, ids: np.ndarray) -> np.ndarray:
    """Log-probabilities of the ids of a padded run; 0 for the zeros between texts."""
    out = np.zeros(len(ids) - 2 * REACH, np.float32)
    words = np.flatnonzero(ids[REACH : len(ids) - REACH])
    for k in range(0, len(words), AT_ONCE):
        at = words[k : k + AT_ONCE]
        out[at] = log_probs(net, tree, np.stack([ids[REACH + p + at] for p in PLACES], axis=1).astype(np.int64), ids[REACH + at].astype(np.int64))
    return out


def scored(texts: DataFrame, tree: Tree, net: Network, rare: DataFrame, least: int) -> DataFrame:
    """texts, a table made by numbered, with n_tokens, log_likelihood (their sum) and mean_log_prob in place of its columns.
    rare: word_shares, of which those of a count under least are joined."""
    shipped = texts.sparkSession.sparkContext.broadcast((tree.__dict__, net.flat()))
    keep = [c for c in texts.columns if c not in ("ids", "others")]

    def make():
        state, weights = shipped.value
        own_tree = Tree.of(state)
        own = Network(own_tree).load(weights)

        def step(batch: pa.RecordBatch) -> dict:
            counts, sums, ids = [], [], batch.column("ids").to_pylist()
            for k in range(0, len(ids), 64):
                part = ids[k : k + 64]
                # the zeros between texts part them; scores of zeros are left out
                logs, at = score(own, own_tree, padded(part)).astype(np.float64), 0
                for x in part:
                    n = len(x) // 2
                    counts.append(n)
                    sums.append(float(logs[at : at + n].sum()))
                    at += n + 2 * REACH
            return {c: batch.column(c) for c in keep} | {"n_tokens": counts, "in_leaves": sums}

        return step

    schema = StructType([*(texts.schema[c] for c in keep), *StructType.fromDDL("n_tokens long, in_leaves double")])
    rows = map_batches(texts.select(*keep, "ids"), make, schema)
    other = texts.select(F.col("row").alias("r"), F.explode("others").alias("hash"))
    summed = other.join(rare.where(F.col("n") < least).select("hash", "share"), "hash").groupBy("r").agg(F.sum("share").alias("joined"))
    found = rows.join(summed, F.col("row") == F.col("r"), "left")
    found = found.withColumn("log_likelihood", F.col("in_leaves") + (F.col("known") + F.coalesce("joined", F.lit(0))) / 1e9)
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return found.withColumn("mean_log_prob", mean).drop("row", "r", "known", "joined", "in_leaves")


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and mean_log_prob of every row, by a network trained on docs themselves.

    Null and empty texts teach nothing, have 0 tokens, a sum of 0 and a null mean; repeated rows teach each and score
    alike; an empty table gives no rows. Extra columns are left out. The same rows give the same scores, however they are cut
    into files and tasks, on machines whose floating point is alike.
    """
    rows = docs.select("doc_id", "text")
    counts = written(word_counts(rows), "word_counts")
    found = vocabulary(counts)
    common = [w for w, _ in found]
    rare = rare_words(counts, common)
    discarded(counts)
    in_bucket, words = bucket_sums(rare)
    tree = Tree(np.concatenate((np.array([n for _, n in found], float), in_bucket + SMOOTH)))
    shares = word_shares(rare, in_bucket + SMOOTH * (words + 1))
    least, hashes, logs = broadcast_shares(shares)
    texts = written(numbered(rows, common, hashes, logs, ["doc_id"]).withColumn("row", F.monotonically_increasing_id()), "numbered")
    return scored(texts, tree, trained(texts, tree), shares, least)


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; nulls, empty texts, repeated rows and empty tables as in pseudo_likelihood."""
    return pseudo_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet"))
