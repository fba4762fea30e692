"""Every operator against plain Python over the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import queries, token_counts, tokens

Q = queries.QUERIES


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


ODD = ["a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.2.3", "+1 (487) 555-7209 +1 4", "4111 1111 1111 1111", "4111-1111-1111-1112 x 4111111111111111", "é a.b@c.de 🙂 1.2.3.4 +49 30 1234567", "a@b @c.d %@x.y a@b..c", " ".join(f"{i % 256}.1.2.{i % 300}" for i in range(400)), "x" * 5000 + "@", "1 " * 9000]


def test_op1(spark, small, texts, tmp_path):
    at = f"file://{tmp_path}"
    spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    for folder, wanted in ((small, texts), (at, dict(enumerate(ODD)))):
        for r in Q["op1_contextual_pii"](spark, folder).collect():
            base = base_spans(wanted[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), r["doc_id"]
            assert [r[f"n_{k}"] for k in PLAIN] == [sum(x.startswith(k) for x in base.split(",")) for k in PLAIN]
            assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_op1_finds_what_stands_in_a_seeds_context(spark, tmp_path):
    seeds = [f"please mail account id user{i}@mail.org now" for i in range(12)]
    rows = [*seeds, "please mail account id QX-77881 now", "the year 19991234 was fine"]
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["spans"] for r in Q["op1_contextual_pii"](spark, f"file://{tmp_path}").collect()}
    assert found[12] == "context:23:31" and found[13] == "" and found[0] == "email:23:37"


def test_keys_are_found_by_context(spark, small, tmp_path):
    """Hexadecimal keys are reported where a confirmed pattern names them, and so is what stands there otherwise."""
    keys = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(9)]
    rows = [f'some words {"abcdefgh"[i]} token = "{k}" and more' for i, k in enumerate(keys[:8])]
    rows += ['other words token = "zz-1234-5678" end', f"a lone digest {keys[8]} here", "| a | 1234567890123456 | b |"]
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["spans"] for r in Q["op1_contextual_pii"](spark, f"file://{tmp_path}").collect()}
    assert found == {i: "context:22:62" for i in range(8)} | {8: "context:21:33", 9: "", 10: ""}
    middle = small.replace("0.001", "0.01")
    planted = {r["doc_id"] for r in spark.read.parquet(f"{middle}/documents.parquet").where("text rlike 'token = \"[0-9a-f]{40}\"'").collect()}
    caught = {r["doc_id"] for r in Q["op1_contextual_pii"](spark, middle).where("spans like '%context%'").collect()}
    assert planted and planted == caught


def test_many_spans_in_one_text(spark):
    from tidemark.llm import pii

    text = " ".join(f"u{i}@mail.org id{i}-99887 \U0001f642 {'x' * (i % 50)}" for i in range(6000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    clash = docs.select("*", *(F.lit("other").alias(c) for c in ("_row", "_hashes", "_base", "_others", "_new", "row", "key", "runs", "spans", "_h", "start", "whole")))
    got = {r["doc_id"]: r for r in pii.redacted(clash).collect()}
    want = re.sub(r"id(\d+)-99887", lambda m: "[CONTEXT]" if len(m[0]) >= 6 else m[0], re.sub(r"u\d+@mail.org", "[EMAIL]", text))
    assert (got[2]["text"], got[3]["text"], got[1]["_row"], got[1]["runs"]) == (None, "", "other", "other")
    assert re.sub(r"\[CONTEXT\]|id\d+-99887", "*", got[1]["text"]) == re.sub(r"\[CONTEXT\]", "*", want)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def test_op2(spark, small, texts):
    got = {r["doc_id"]: r for r in Q["op2_simhash"](spark, small).collect()}
    prints, least = components_of(texts)
    assert {d: (r["fingerprint"], r["component_id"]) for d, r in got.items()} == {d: (f"{prints[d]:016x}", least[d]) for d in texts}


def test_links_lose_none_and_tiles_agree(spark, monkeypatch):
    from tidemark.llm import simhash

    draw = np.random.default_rng(3)
    centres = draw.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in draw.choice(64, draw.integers(1, 9), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    wanted = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}

    def classes(pairs):
        up = {x: x for x in fps}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return {x: root(x) for x in fps}

    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    for tile in (simhash.TILE, 20):
        monkeypatch.setattr(simhash, "TILE", tile)
        found = {tuple(sorted((r["u"] % (1 << 64), r["v"] % (1 << 64)))) for r in simhash.links(df).collect()}
        assert found <= wanted and classes(found) == classes(wanted)


def test_components(spark):
    from tidemark.llm.graph import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 100)] + [(300, k) for k in range(301, 340)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, 200: 100} | {k: 300 for k in range(300, 340)}


def test_op3(spark, small, texts):
    encode = tokens.byte_bpe(tokens.BYTE_BPE)
    wanted = Counter((d, len(encode(t))) for d, t in texts.items())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in Q["op3_token_counts"](spark, small).collect()) == wanted
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.document_counts(docs, block=50).collect()) == wanted


def test_flat_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 3)
    draw, wanted = np.random.default_rng(1), Counter()
    for name in ("a", "b", "c"):
        ids = draw.choice(np.array([1, 2, 3, 9], "<u4"), 500 if name != "c" else 0, p=[0.5, 0.3, 0.15, 0.05])
        ids.tofile(tmp_path / f"{name}.bin")
        ends = np.flatnonzero(ids == 9)
        starts = np.concatenate(([0], ends + 1))
        for k, (s, e) in enumerate(zip(starts.tolist(), [*ends.tolist(), len(ids)], strict=True)):
            if k < len(ends) or e > s:
                wanted[name, k, s, e - s, k < len(ends)] += 1
    monkeypatch.setattr(token_counts, "RANGE_BLOCKS", 2)  # so that files are read in several ranges
    blocks = token_counts.token_files(spark, f"file://{tmp_path}/*.bin", block=7, width=4)
    assert len({r["p"] for r in blocks.where("file like '%a.bin'").select(F.spark_partition_id().alias("p")).collect()}) > 1
    got = Counter((r["file"][-5], r["document"], r["first_token"], r["n_tokens"], r["ended"]) for r in token_counts.counted(blocks, end_id=9, width=4).collect())
    assert got == wanted


def test_flat_files_of_half_ids_are_refused(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"12345")
    with pytest.raises(Exception, match="no whole ids"):
        token_counts.token_files(spark, f"file://{tmp_path}/odd.bin").collect()


def test_op4(spark, small, texts):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = word.findall(lower(r["text"]))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(r["item_id"])
    sizes = {len(w) for w in windows}
    for r in Q["op4_winnowing"](spark, small).collect():
        w, hit, items = word.findall(lower(texts[r["doc_id"]])), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    items |= found
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(w), len(hit), len(items), digest, bool(hit))


def test_benchmarks_of_any_size_agree(spark, small, monkeypatch):
    from tidemark.llm import decontamination as D

    docs, benchmark = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    results = []
    for broadcast, most in ((D.BROADCAST_WINDOWS, D.MOST_BITS), (0, D.LEAST_BITS)):  # by a broadcast; by salted shuffles and a full bitmap
        monkeypatch.setattr(D, "BROADCAST_WINDOWS", broadcast)
        monkeypatch.setattr(D, "MOST_BITS", most)
        results.append({r["doc_id"]: (r["n_words"], r["hit_spans"], r["hit_items"]) for r in D.scanned(docs, benchmark).collect()})
    assert results[0] == results[1]
    clean = {r["doc_id"] for r in D.decontaminated(docs, benchmark).collect()}
    assert clean == {d for d, (_, spans, _) in results[0].items() if not spans}


def test_equal_hashes_and_empty_ids(spark):
    from tidemark.llm.decontamination import scanned

    same = "x " * 14  # all k-grams are equal
    docs = spark.createDataFrame([(1, "a " + same + "b"), (2, "x " * 9 + "a"), (3, "Tiny item"), (4, "one two three")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("", "x " * 10), (None, "tiny ITEM"), ("k", same), ("two words", "two three")], "item_id string, text string")
    got = {r["doc_id"]: ([tuple(x) for x in r["hit_spans"]], r["hit_items"]) for r in scanned(docs, benchmark).collect()}
    assert got == {1: ([(1, 15)], ["", "k"]), 2: ([], []), 3: ([(0, 2)], []), 4: ([(1, 3)], ["two words"])}


def test_op5(spark, small, texts):
    rows = Q["op5_sharding"](spark, small).collect()
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_moves_stay_in_changed_subtrees(spark):
    from tidemark.llm.sharding import assign, topology

    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    both = assign(assign(ids, topology(24)), topology(24, weights={3: 3.0}), column="after").collect()
    moved = [(r["shard"], r["after"]) for r in both if r["shard"] != r["after"]]
    # region 0 and its first rack gain weight: nothing moves between regions 1 and 2, or out of that rack
    assert moved and all(after < 8 for _, after in moved) and all(after < 4 for before, after in moved if before < 8)
    counts = Counter(r["after"] for r in both)
    assert counts[3] > 2 * counts[2]


def plain_score(text, texts, common, counts, paths, net, places=(-2, -1, 1, 2)):
    """The sum of log-probabilities of a text's words, one word, step and unit at a time."""
    import math

    from tidemark.llm.scoring import BUCKETS, SMOOTH

    words = (text or "").encode().lower().split()
    bucket = lambda w: xxhash.xxh64_intdigest(w) % BUCKETS
    number = lambda w: 1 + common.index(w) if w in common else 1 + len(common) + bucket(w)
    total, n = 0.0, len(net.into) // len(places)
    for i, w in enumerate(words):
        around = [number(words[i + k]) if 0 <= i + k < len(words) else 0 for k in places]
        h = [math.tanh(sum(float(net.into[k * n + a, d]) for k, a in enumerate(around)) + float(net.hidden[0, d])) for d in range(net.into.shape[1])]
        for node, side in paths[number(w)]:
            z = sum(float(a) * b for a, b in zip(net.out[node], h, strict=True)) + float(net.out_bias[node, 0])
            total -= math.log1p(math.exp(-side * z))
        if w not in common:
            own = [x for x in counts if x not in common and bucket(x) == bucket(w)]
            total += math.log((counts[w] + SMOOTH) / (sum(counts[x] for x in own) + SMOOTH * (len(own) + 1)))
    return total


def test_op6_equals_plain_python(spark, monkeypatch):
    from tidemark.llm import scoring as S

    draw, given = np.random.default_rng(4), {}
    texts = [" ".join(f"w{int(x)}" for x in draw.geometric(0.05, draw.integers(1, 30))) for _ in range(60)] + [None, "", "Alone", "w1 W1 w1"]

    def weights(_, tree):
        net = S.Network(tree)
        for part in net.parts():
            part[...] = draw.normal(0, 0.7, part.shape)
        given.update(net=net, tree=tree)
        return net

    monkeypatch.setattr(S, "trained", weights)
    counts = Counter(w for t in texts for w in (t or "").encode().lower().split())
    common = [w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= S.LEAST]
    assert 3 < len(common) < len(counts) - 10
    rows = S.pseudo_likelihood(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    tree = given["tree"]
    paths = [[(k, int(s)) for k, s in enumerate(tree.top[i]) if s] + [(abs(int(x)) - 1, 1 if x > 0 else -1) for x in tree.deep[:, i] if x] for i in range(len(tree.depth))]
    assert sum(np.prod([0.5 for _ in p]) for p in paths[1:]) == pytest.approx(1)  # leaves of one whole tree
    for r in rows:
        assert r["log_likelihood"] == pytest.approx(plain_score(texts[r["doc_id"]], texts, common, counts, paths, given["net"]), rel=1e-5, abs=1e-4)
        assert r["n_tokens"] == len((texts[r["doc_id"]] or "").split())


def test_op6(spark, small, texts):
    rows = Q["op6_pseudo_likelihood"](spark, small).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {d: len((t or "").encode().split()) for d, t in texts.items()}
    again = {r["doc_id"]: r["log_likelihood"] for r in Q["op6_pseudo_likelihood"](spark, small).collect()}
    assert again == {r["doc_id"]: r["log_likelihood"] for r in rows}
    # better than the words' shares of the corpus, which no context can tell
    counts = Counter(w for t in texts.values() for w in (t or "").encode().lower().split())
    total = sum(counts.values())
    assert sum(r["log_likelihood"] for r in rows) / total > sum(n * np.log(n / total) for n in counts.values()) / total


def test_network_learns():
    from tidemark.llm import scoring as S

    draw = np.random.default_rng(0)
    runs = draw.integers(1, 9, (60_000, 5)).astype(np.uint16)
    runs[:, 2] = np.where(runs[:, 1] < 5, runs[:, 3], runs[:, 1])  # told by both sides
    tree = S.Tree(np.bincount(runs[:, 2], minlength=9)[1:].astype(float))
    net, around = S.Network(tree), np.delete(runs, 2, axis=1).astype(np.int64)
    for _ in range(12):
        S.train(net, tree, runs, 0.3)
    each = np.stack([S.log_probs(net, tree, around[:500], np.full(500, k)) for k in range(1, 9)])
    assert np.allclose(np.exp(each).sum(axis=0), 1, atol=1e-4)
    assert S.log_probs(net, tree, around, runs[:, 2].astype(np.int64)).mean() > -1.2 > np.log(1 / 8)


def test_hosts_decide_rows_and_leave_clean_ones(spark, small):
    middle = small.replace("0.001", "0.01")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{middle}/labels.parquet").collect()}
    rows = Q["op7_host_quality"](spark, middle).collect()
    decided = [r["doc_id"] for r in rows if not r["base_failed"] and not r["kept"]]
    clean = [r for r in rows if quality.get(r["doc_id"]) == 1]
    assert len(decided) > 20 and not any(quality.get(d) == 1 for d in decided)
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean) > 0


def test_a_bad_host_loses_its_doubtful_documents_only(spark):
    from tidemark.llm.quality import judged

    good = "a plain sentence of words that differ and tell a small story about some river {}"
    symbols = "## ** $$ %% && text {} with ## many ** marks $$ between %% its words && and ## on"
    rows = [(i, symbols.format(i), "bad") for i in range(60)] + [(100 + i, good.format(i), "bad") for i in range(5)]
    rows += [(200 + 100 * h + i, good.format(i), f"good{h}") for h in range(5) for i in range(60)] + [(900, symbols.format("x"), "good0")]
    kept = {r["doc_id"] for r in judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("kept").collect()}
    assert kept == {d for d, _, s in rows if d >= 100}


def test_hosts_part_the_same_documents(spark):
    """One failing, one slipping and one clean text on a good host, on hosts like most and on a bad one."""
    from tidemark.llm.quality import judged

    clean = "a plain sentence of words that differ and tell a small story about some river {}"
    slip = "a plain sentence ## of words that differ and tell a small story about some river {}"
    fail = "## a $$ plain sentence of && words %% that differ and tell a small story about river {}"
    rows, verdicts = [], {}
    for h, failing in enumerate([0] + [20] * 8 + [90]):
        for i in range(100):
            rows.append((1000 * h + i, (fail if i < failing else clean).format(i), f"host{h}"))
        rows += [(1000 * h + 500 + k, text.format("x"), f"host{h}") for k, text in enumerate((fail, slip, clean))]
    kept = {r["doc_id"] for r in judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("kept").collect()}
    for h in range(10):
        verdicts[h] = tuple(1000 * h + 500 + k in kept for k in range(3))
    assert verdicts == {0: (True, True, True)} | {h: (False, True, True) for h in range(1, 9)} | {9: (False, False, True)}


def test_op8_and_op10_held_out(spark, small):
    middle = small.replace("0.001", "0.01")
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{middle}/documents.parquet").collect()}
    rows = [r for r in Q["op10_language"](spark, middle).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.95 * len(rows) > 0
    scores = Q["op8_toxicity"](spark, middle).collect()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) for r in scores)


def test_toxic_words_are_learned(spark):
    from tidemark.llm.toxicity import judged

    draw = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*draw.choice(words, 40), *(draw.choice(["vile", "awful"], 2) if i % 4 == 0 else [])])) for i in range(1200)]
    docs = spark.createDataFrame([(a, str(b)) for a, b in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "doc_id long, toxic int")
    held = [r for r in judged(docs, labels).collect() if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)


def test_op9(spark, small, texts):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in Q["op9_packing"](spark, small).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, t in texts.items():
        ids, at = [*whole.encode(t or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    assert set(sequences) == set(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(n for own in sequences.values() for _, n in own)
    assert total >= 0.95 * 4096 * (len(sequences) - 1)


def test_plan_places_every_piece():
    from tidemark.llm.packing import nonnegative_least_squares, plan

    draw = np.random.default_rng(5)
    for counts in (draw.integers(0, 50, 64), np.zeros(64, int), np.eye(64, dtype=int)[40] * 9, np.eye(64, dtype=int)[0] * 1000):
        p = plan(counts)
        used = Counter()
        for pattern, n in zip(p.patterns, p.repeats, strict=True):
            assert sum(pattern) <= 64 and n > 0
            for k in pattern:
                used[k] += n
        assert [used[k + 1] for k in range(64)] == counts.tolist()
    a, b = draw.random((30, 12)), draw.random(30)
    x = nonnegative_least_squares(a, b)
    gradient = a.T @ (a @ x - b)
    assert (x >= 0).all() and (gradient >= -1e-6).all() and abs(gradient @ x) < 1e-6


def test_ids_are_the_tokenizers_own():
    whole = Tokenizer.from_file(tokens.WORD_BPE)
    bpe = tokens.WordBpe(tokens.WORD_BPE, tokens.unlisted(tokens.WORD_BPE))
    for text in ["I'm it's we'LL 'D don't", "İstanbul ΣΑΣ ΟΔΟΣ", "a\xa0b\x85c\x1cd", "naïve café ÀÉ 12½ x²", "🙂 hi​there", "<|endoftext|> x", "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext |>", "日本<|endoftext|>", "日本語 テスト", " \n", "éa", "x" * 300]:
        assert bpe.ids(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered, seen, same = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 5))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), same, len(covered)


def failures(text):
    n, chars, symbols, same, repeated = figures(text)
    return [n < 10 or 100 * repeated > 20 * n, 100 * symbols > 25 * n, same >= 3 and same * 20 > n, n > 0 and not 3 * n <= chars <= 14 * n]


def test_op7(spark, small, texts):
    hosts = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    kept = kept_by_quality(texts, hosts)
    for r in Q["op7_host_quality"](spark, small).collect():
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == figures(texts[r["doc_id"]])
        assert r["base_failed"] == failures(texts[r["doc_id"]])[0] and r["kept"] == (r["doc_id"] in kept)


def slips(text):
    n, chars, symbols, same, _ = figures(text)
    return [False, 100 * symbols > 10 * n, same >= 1 and same * 40 > n, n > 0 and not 7 * n <= 2 * chars <= 24 * n]


def kept_by_quality(texts, hosts):
    fails = {d: failures(t) for d, t in texts.items()}
    by_host = defaultdict(list)
    for d in texts:
        by_host[hosts[d]].append(fails[d])
    total, doubtful, bad = len(texts), defaultdict(set), defaultdict(set)
    for rule in range(1, 4):
        rates = {h: (len(f), sum(x[rule] for x in f)) for h, f in by_host.items()}
        mean = sum(k for _, k in rates.values()) / total
        between = sum(k * k / n for n, k in rates.values()) / total - mean * mean - mean * (1 - mean) * len(rates) / total
        weight = min(10_000, max(1, mean * (1 - mean) / between - 1)) if between > 0 else 10_000
        deviation = (mean * (1 - mean) / (weight + 1)) ** 0.5
        for h, (n, k) in rates.items():
            for verdict, limit in ((doubtful, mean - 2 * deviation), (bad, mean + 2 * deviation)):
                if (k + weight * mean) / (n + weight) > max(0.02, limit):
                    verdict[h].add(rule)
    return {d for d in texts if not fails[d][0] and not any(fails[d][r] for r in doubtful[hosts[d]]) and not any(slips(texts[d])[r] for r in bad[hosts[d]])}


def components_of(texts):
    prints, least, changed = {d: fingerprint(t) for d, t in texts.items()}, {d: d for d in texts}, True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if least[a] > least[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                    least[a], changed = least[b], True
    return prints, least


def redacted(text):
    spans = sorted((int(a), int(b), kind.upper()) for kind, a, b in (x.split(":") for x in base_spans(text).split(",") if x))
    out, at = [], 0
    for k, (a, b, kind) in enumerate(spans):
        if a >= at or not k:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def plain_bits(text):
    """The wide fingerprint, one bit at a time."""
    from tidemark.llm.near_copies import _ODD, SHINGLE

    words, mask = [xxhash.xxh64_intdigest(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", lower(text))], (1 << 64) - 1
    n = min(SHINGLE, len(words))
    hashes = {(n + sum(w * int(o) for w, o in zip(words[i : i + n], _ODD, strict=False))) & mask for i in range(len(words) - n + 1)} if n else set()
    counts = [0] * 1024
    for h in hashes:
        for k in range(16):
            x = (h + (k + 1) * 0x9E3779B97F4A7C15) & mask
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
            x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
            x ^= x >> 31
            for b in range(64):
                counts[64 * k + b] += x >> b & 1
    return sum(1 << i for i, c in enumerate(counts) if 2 * c > len(hashes))


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b) - 1e-9


def heads_of(texts):
    """The least doc_id that pairs of similarity 0.8 or more reach, by all pairs."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    pairs = [(a, b) for a in texts for b in texts if a > b and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) - 1e-9 and alike(sets[a], sets[b])]
    least, changed = {d: d for d in texts}, True
    while changed:
        changed = False
        for a, b in pairs:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


def test_near_copies(spark):
    from tidemark.llm import near_copies as N

    draw = np.random.default_rng(2)
    texts = []
    for _ in range(25):
        words = [f"w{int(x)}" for x in draw.integers(0, 3000, 200)]
        texts.append(" ".join(words))
        for cut in (1, 2, 3, 30):  # words changed: similarity about 0.95, 0.9, 0.86 and 0.15
            own = list(words)
            for k in draw.choice(200, cut, replace=False):
                own[k] = "new"
            texts.append(" ".join(own))
    texts += [None, "", " \t", "one two", "ONE  two", texts[0], texts[0]]
    for t in texts[:6] + ["one two", None]:
        assert int.from_bytes(N.wide_fingerprint(t), "little") == plain_bits(t)
    kept = {r["doc_id"] for r in N.without_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    least = heads_of(dict(enumerate(texts)))
    assert kept == set(least.values()) and {0, 4, 125, 128} <= kept
    assert not kept & {1, 2, 3, 126, 127, 129, 130, 131}


def test_only_similar_texts_are_linked(spark):
    """Among families of look-alikes, planted pairs over the limit are found and nothing under it is linked."""
    from tidemark.llm import near_copies as N

    draw = np.random.default_rng(8)

    def changed(words, n, mark):
        own = list(words)
        for k in draw.choice(len(words) // 6, n, replace=False):
            own[6 * k + 2] = f"{mark}{k}"  # apart from each other: five shingles each
        return own

    texts, planted = [], []
    for family in range(4):
        words = [f"f{family}w{int(x)}" for x in draw.integers(0, 4000, 300)]
        for i in range(60):  # about 0.6 to 0.7 to each other
            own = changed(words, 9, f"x{family}i{i}y")
            texts.append(" ".join(own))
            if i % 3 == 0:  # 0.85
                planted.append((len(texts) - 1, len(texts)))
                texts.append(" ".join(changed(own, 4, f"z{i}")))
    least = heads_of(dict(enumerate(texts)))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashed = rows.select("doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(2), "text").alias("h2"), "text")
    from tidemark.llm.common import written

    prints = written(N.fingerprinted(hashed, ["doc_id", "h", "h2"]), "prints_of_a_test")
    groups = N.grouped(prints, hashed)
    found = {}
    for r in prints.join(groups.select("bits", "root"), "bits").collect():
        found.setdefault(r["root"], []).append(r["doc_id"])
    for own in found.values():
        assert len({least[d] for d in own}) == 1  # no link that isn't one
    together = {d: root for root, own in found.items() for d in own}
    sure = [(a, b) for a, b in planted if alike(shingle_set(texts[a]), shingle_set(texts[b]))]
    assert len(sure) > 60 and sum(together[a] == together[b] for a, b in sure) >= 0.98 * len(sure)


def test_a_large_group_stays_small(spark, monkeypatch):
    """Copies of one text with one word changed, over many batches: roots alone are passed on, and one row stays."""
    from tidemark.llm import near_copies as N

    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join([*words[: i % 300], f"x{i}", *words[i % 300 :]])) for i in range(3000)], "doc_id long, text string").repartition(5)
    rows = N.fingerprinted(docs, ["doc_id"]).select(F.col("doc_id").alias("node"), "bits")
    left = N.keyed(rows, 3000).where(F.col("key") != N.EDGE).groupBy("key").count().agg(F.max("count")).first()[0]
    assert left < 1500
    assert [r["doc_id"] for r in N.without_near_copies(docs).collect()] == [0]


def test_pipeline(spark, small, texts):
    """All stages against plain Python; the smallest tables have no contexts beyond the seeds'."""
    import corpus_pipeline

    hosts = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    contaminated = {r["doc_id"] for r in Q["op4_winnowing"](spark, small).where("contaminated").collect()}  # itself tested above
    left = {d: texts[d] for d in kept_by_quality(texts, hosts)}
    left = {d: left[d] for d, head in heads_of(left).items() if head == d}
    left = {d: redacted(t) for d, t in left.items() if d not in contaminated}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, small).collect():
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(left)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for d, t in left.items():
        ids = [*whole.encode(t, add_special_tokens=False).ids, 2]
        own = sorted(pieces[d], key=lambda r: r["start"])
        assert [(r["start"], r["ids_crc32"]) for r in own] == [(a, zlib.crc32(np.array(ids[a : a + r["length"]], "<u4").tobytes())) for a, r in zip(np.cumsum([0, *(r["length"] for r in own)]).tolist(), own, strict=False)]
        assert sum(r["length"] for r in own) == len(ids)


def test_op8_fit_equals_plain_python():
    """FTRL-proximal one coordinate at a time."""
    import math

    from tidemark.llm import toxicity as T

    draw = np.random.default_rng(1)
    rows = [(int(draw.random() < 0.3), np.concatenate(([0], np.unique(draw.integers(1, 40, 8))))) for _ in range(60)]
    model = T.fit(rows, (0.5, 0.25), T.Settings(0.7, 0.4, 2))
    z, n, order = Counter(), Counter(), np.random.default_rng(8)

    def weight(k):
        l1 = 0.4 if k else 0.0
        return 0.0 if abs(z[k]) <= l1 else (math.copysign(l1, z[k]) - z[k]) / ((T.BETA + math.sqrt(n[k])) / 0.7 + T.L2)

    for _ in range(2):
        for i in order.permutation(60).tolist():
            label, places = rows[i]
            w = {k: weight(k) for k in places.tolist()}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for k, x in w.items():
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.7 * x
                n[k] += g * g
    assert dict(zip(model.places.tolist(), model.weights.tolist(), strict=True)) == pytest.approx({k: weight(k) for k in z if k and weight(k)}, rel=1e-5)
    assert model.intercept == pytest.approx(weight(0) + math.log(2))


def test_op8_on_the_held_out_fold(spark, small):
    middle = small.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{middle}/labels.parquet").collect()}
    held = [r for r in Q["op8_toxicity"](spark, middle).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    caught = sum(r["predicted"] == labels[r["doc_id"]] == 1 for r in held)
    false = sum(r["predicted"] == 1 and labels[r["doc_id"]] == 0 for r in held)
    assert caught >= 0.6 * sum(labels[r["doc_id"]] for r in held) > 0 and false <= 0.02 * len(held)


def test_op8_samples_are_bounded_and_repeats_count(spark):
    from tidemark.llm import toxicity as T

    docs = spark.createDataFrame([(i // 2, f"word{i} other{i % 7} last") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1000, 1)], "doc_id long, label int")
    rows, counts = T.sampled(docs, labels)
    assert len(rows) == 80 and counts == {0: 40, 1: 40}
    assert Counter(label for _, label, _ in T.sampled(docs, labels, 5)[0]) == {0: 5, 1: 5}
    assert sum(len(at) - 1 for _, _, at in T.sampled(docs, labels, 40, 100)[0]) <= 100
    one = T.judged(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")).collect()
    assert all(r["score"] < 1e-9 and r["predicted"] == 0 for r in one)


def test_op10_vectors_equal_plain_python():
    """Bundles of bound, rotated letter vectors, one n-gram and one dimension at a time."""
    from tidemark.llm import language as L

    numbers, rotated = L._letters()
    vectors = rotated[L.GRAM - 1]  # the last letter's are not rotated
    for text in ("Ab ba", "é  xyz", "one two one", "..."):
        letters = [0]
        for c in text.lower() + "\0":
            k = int(numbers[ord(c)])
            if k or letters[-1]:
                letters.append(k)
        total = np.zeros(L.DIMENSIONS)
        for i in range(len(letters) - L.GRAM + 1):
            gram = letters[i : i + L.GRAM]
            for d in range(L.DIMENSIONS):
                x = 1
                for place, k in enumerate(gram):
                    x *= int(vectors[k, (d - (L.GRAM - 1 - place)) % L.DIMENSIONS])
                total[d] += x
        want = total / np.linalg.norm(total) if total.any() else total
        assert np.allclose(L.bundles([text])[0], want, atol=1e-6)
