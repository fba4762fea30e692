"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Mail addresses, IP addresses, card and phone numbers are found by fixed patterns. They are
the seeds, and so are long hexadecimal keys, which are reported only where their context is confirmed. The words
and marks around seeds are lexical patterns, and a graph joins patterns with the
instances (seeds, and other strings of an identifier's shape) that stand in them. Over some
rounds a pattern's score is the share of its distinct instances' scores, and an instance's
is the chance that one of its patterns at least is right. Patterns of high score and enough
support name the unseen identifiers that stand in them; those spans are added to the seeds'.
Support is the seeds and the instances that the round before scored high, so each round can
admit further patterns.

A pattern is the last two words before an identifier with the marks among and after them; the last word alone where
marks follow it, as in `key: "`; or the words on either side. A word has a letter or a digit: marks alone are no
pattern. Words are whole, however long.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discarded, private, written

#: Kinds in order, and their patterns. Possessive quantifiers and look-behinds match what the plain patterns
#: match, leftmost and longest, but never go back over a long run of characters.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CONTEXT = "context"
#: Strings of an identifier's shape: letters and digits, joined by single marks, with a digit after any number of
#: letters. Plain words are none, so that they stand between matches as context.
SHAPE = r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._@/+:-])(?=[A-Za-z]*+(?:[._@/+:-][A-Za-z]++)*+[._@/+:-]?+[0-9])[A-Za-z0-9]++(?:[._@/+:-][A-Za-z0-9]++)*+"
LEAST_DIGITS, LEAST_LENGTH = 4, 6
#: Instances that seed patterns, but are reported only in a confirmed one.
KEY = r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,64}$"
#: Characters on either side in which context words are sought first, and those beyond which a word stands as its hash.
REACH, LONG_WORD = 64, 64
#: A word, and what a pattern of one word must end with.
WORD, MARKED = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}\s]$"
ROUNDS, LEAST_SEEDS, LEAST_SCORE = 3, 3, 0.8
#: Texts with new spans, or with any, are broadcast if there are at most so many, else joined by shuffles.
BROADCAST_TEXTS = 100_000
#: Texts are cut and put together again in blocks of so many characters.
TEXT_BLOCK = 4096


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    """Whether a match of a kind's pattern is one of that kind."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))
    n = F.length(_digits(match))
    if kind == "phone":
        return n.between(9, 15)
    if kind == "card":
        digit = lambda i: F.substring(F.reverse(_digits(match)), i + 1, F.lit(1)).cast("int")
        doubled = lambda i: F.when(i % 2 == 0, digit(i)).when(digit(i) > 4, 2 * digit(i) - 9).otherwise(2 * digit(i))
        luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + doubled(i))
        return F.when(n.between(12, 19), luhn % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, b: a + b)


def _tokens(piece: Column) -> Column:
    """What white space parts in a piece of text, lower-case and with 0 for each digit."""
    found = F.filter(F.split(F.regexp_replace(F.lower(piece), "[0-9]", "0"), r"\s+"), lambda w: w != "")
    return F.transform(found, lambda w: F.when(F.length(w) > LONG_WORD, F.concat(F.lit("#"), F.sha2(w, 256))).otherwise(w))


def _near(piece: Column, last: bool, words: int) -> Column:
    """The tokens at the end (or start) of a piece that hold so many whole words; all, if it has fewer."""
    near = _tokens(F.substring(piece, -REACH, REACH) if last else F.substring(piece, 1, REACH))
    # one word more, for the first (or last) one may be cut
    whole = (F.length(piece) <= REACH) | (F.size(F.filter(near, lambda w: w.rlike(WORD))) > words)
    return F.when(whole, near).otherwise(_tokens(piece))


def _places_of_words(tokens: Column) -> Column:
    return F.filter(F.transform(tokens, lambda w, i: F.when(w.rlike(WORD), i)), lambda i: i.isNotNull())


def _context(piece: Column) -> Column:
    """Of a piece between matches: what stands before the next match (its last word, and its last two, each with the marks
    after it) and after the last one (its first word with the marks before it); null where there is no such word."""
    before, after = _near(piece, True, 2), _near(piece, False, 1)
    tail = lambda k: F.array_join(F.slice(before, F.try_element_at(_places_of_words(before), F.lit(-k)) + 1, F.size(before)), " ")
    head = F.array_join(F.slice(after, F.lit(1), F.try_element_at(_places_of_words(after), F.lit(1)) + 1), " ")
    return F.struct(tail(1).alias("one"), tail(2).alias("two"), head.alias("next"))


def _located(df: DataFrame, searches: dict[str, tuple[str, Column]]) -> DataFrame:
    """df with, for each name, an array of start, end (code points), match and patterns for each match in the
    column text of a regular expression, where its gate is true.

    The text between matches and the matches themselves give the places by their lengths, summed in blocks of about the
    root of their number. All searches go through each step together, so that the plan stays short.
    """
    none = F.array().cast("array<string>")
    each = {f"_{step}_{name}": (name, step) for name in searches for step in ("m", "p", "s", "b", "c", "n")}
    df = df.withColumns({f"_m_{n}": F.when(gate, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none) for n, (pattern, gate) in searches.items()})
    df = df.withColumns({f"_p_{n}": F.when(F.size(f"_m_{n}") > 0, F.split("text", pattern, -1)).otherwise(none) for n, (pattern, _) in searches.items()})

    def size(n: str, p: Column, i: Column) -> Column:
        return F.length(p) + F.coalesce(F.length(F.get(f"_m_{n}", i)), F.lit(0))

    def block(n: str, b: Column) -> Column:
        return _sum(F.slice(f"_s_{n}", b * F.col(f"_n_{n}") + 1, F.col(f"_n_{n}")))

    def span(n: str, m: Column, i: Column) -> Column:
        blocks = F.floor(i / F.col(f"_n_{n}")).cast("int")
        start = _sum(F.slice(f"_b_{n}", F.lit(1), blocks)) + _sum(F.slice(f"_s_{n}", blocks * F.col(f"_n_{n}") + 1, i - blocks * F.col(f"_n_{n}"))) + F.length(F.get(f"_p_{n}", i))
        before, after = F.get(f"_c_{n}", i), F.get(f"_c_{n}", i + 1)
        marked = F.when(before["one"].rlike(MARKED), F.concat(F.lit("l "), before["one"]))
        patterns = F.array(marked, F.concat(F.lit("ll "), before["two"]), F.concat(F.lit("lr "), before["one"], F.lit(" | "), after["next"]))  # null if a word is missing
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"), F.array_compact(patterns).alias("patterns"))

    df = df.withColumns({f"_s_{n}": F.transform(f"_p_{n}", partial(size, n)) for n in searches} | {f"_c_{n}": F.transform(f"_p_{n}", _context) for n in searches})
    df = df.withColumns({f"_n_{n}": F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(f"_s_{n}"))).cast("int")) for n in searches})
    df = df.withColumns({f"_b_{n}": F.transform(F.sequence(F.lit(0), F.floor(F.size(f"_s_{n}") / F.col(f"_n_{n}")).cast("int")), partial(block, n)) for n in searches})
    return df.withColumns({n: F.transform(f"_m_{n}", partial(span, n)) for n in searches}).drop(*each)


def _passing(kind: str, x: Column) -> Column:
    return _passes(kind, x["match"])


def _of_kind(kind: str, x: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), *(x[c].alias(c) for c in ("start", "end", "match", "patterns")))


def _is_kind(kind: str, x: Column) -> Column:
    return x["kind"] == kind


def extracted(docs: DataFrame, base: str, others: str) -> DataFrame:
    """docs with the arrays base and others of kind, start, end, match and patterns: of the seeds, and of all
    strings of an identifier's shape. The column text must be there; a null has neither."""
    text = docs.select(F.struct("*").alias("whole"), "text")  # names of docs can't clash below
    df = text.withColumns({"_digit": F.coalesce(F.col("text").rlike("[0-9]"), F.lit(False)), "_at": F.coalesce(F.contains(F.col("text"), F.lit("@")), F.lit(False))})
    gates = {"email": F.col("_at"), "phone": F.col("_digit") & F.contains(F.col("text"), F.lit("+"))}
    searches = {f"_{kind}": (pattern, gates.get(kind, F.col("_digit"))) for kind, pattern in KINDS.items()}
    df = _located(df, searches | {"_other": (SHAPE, F.col("_digit"))})
    found = F.concat(*(F.transform(F.filter(f"_{kind}", partial(_passing, kind)), partial(_of_kind, kind)) for kind in KINDS))
    shaped = F.filter("_other", lambda x: (F.length(x["match"]) >= LEAST_LENGTH) & (F.length(_digits(x["match"])) >= LEAST_DIGITS))
    return df.select("whole.*", found.alias(base), F.transform(shaped, partial(_of_kind, CONTEXT)).alias(others))


def mentions(found: DataFrame) -> DataFrame:
    """The seeds, and the other strings that overlap none, of rows of row, base and others: row, kind, start, end, match
    and patterns. Each text's spans are swept once, in order."""
    each = found.select("row", F.explode(F.concat("base", "others")).alias("x")).select("row", "x.*").withColumn("is_base", F.col("kind") != CONTEXT)
    order = Window.partitionBy("row").orderBy("start", F.desc("is_base"))
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    swept = each.withColumn("ended", F.max(F.when(F.col("is_base"), F.col("end"))).over(before)).withColumn("starts", F.min(F.when(F.col("is_base"), F.col("start"))).over(behind))
    free = F.coalesce(F.col("ended") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("starts") >= F.col("end"), F.lit(True))
    return swept.where(F.col("is_base") | free).drop("is_base", "ended", "starts")


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, of high score, from mentions. Null matches and patterns are no part of the graph."""
    seed = (F.col("kind") != CONTEXT) | F.col("match").rlike(KEY)
    each = found.select(F.lower("match").alias("instance"), seed.alias("seed"), F.explode("patterns").alias("pattern"))
    edges = written(each.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")).withColumn("score", F.col("seed").cast("double")), "edges")
    for _ in range(rounds):
        of_pattern = edges.groupBy(F.col("pattern").alias("p")).agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("pattern_score"), F.sum((F.col("score") >= LEAST_SCORE).cast("int")).alias("support"))
        weighed = edges.join(of_pattern, F.col("pattern") == F.col("p")).drop("p")
        weighed = written(weighed.withColumn("pattern_score", F.when(F.col("support") >= LEAST_SEEDS, F.col("pattern_score")).otherwise(F.lit(0.0))), "patterns")
        # the chance that one pattern at least is right; a score stays under 1, so its log is finite
        of_instance = weighed.groupBy(F.col("instance").alias("i")).agg((1 - F.exp(F.sum(F.log1p(-F.col("pattern_score"))))).alias("chance"))
        joined = weighed.select("pattern", "instance", "seed").join(of_instance, F.col("instance") == F.col("i"))
        after = written(joined.select("pattern", "instance", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("chance")).alias("score")), "edges")
        discarded(edges, weighed)
        edges = after
    last = edges.groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("score"), F.sum((F.col("score") >= LEAST_SCORE).cast("int")).alias("support"))
    return last.where((F.col("score") >= LEAST_SCORE) & (F.col("support") >= LEAST_SEEDS)).select("pattern")


RANKS = (*KINDS, CONTEXT)


def _span(x: Column) -> Column:
    rank = F.array_position(F.array(*(F.lit(k) for k in RANKS)), x["kind"]).cast("int")
    return F.struct(x["start"].alias("start"), rank.alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, str, str]:
    """docs without their text, with spans of seeds (base_spans), as a table; row and _new (an array of new spans) of the
    rows that have any; and the names of the table's columns of its row and of two hashes of its text, in a struct."""
    row, key, base, others = private(docs, "_row", "_hashes", "_base", "_others")
    hashed = docs.withColumn(key, F.struct(F.xxhash64("text").alias("h"), F.xxhash64(F.lit(2), "text").alias("h2")))
    table = written(extracted(hashed, base, others).drop("text").withColumn(row, F.monotonically_increasing_id()), "identifiers")
    each = written(mentions(table.select(F.col(row).alias("row"), F.col(base).alias("base"), F.col(others).alias("others"))), "mentions")
    good = confident_patterns(each).withColumnRenamed("pattern", "good")
    loose = each.where(F.col("kind") == CONTEXT).select("row", "start", "end", "kind", F.explode("patterns").alias("pattern"))
    named = loose.join(good, F.col("pattern") == F.col("good"), "left_semi").select("row", _span(F.struct("start", "end", "kind")).alias("span"))
    new = written(named.groupBy("row").agg(F.collect_set("span").alias("_new")), "context_spans")  # a text's own
    discarded(each)
    table = table.withColumn("base_spans", F.array_sort(F.transform(base, _span))).drop(base, others)
    return table, new, row, key


def _with_new(table: DataFrame, new: DataFrame, row: str) -> DataFrame:
    if new.count() <= BROADCAST_TEXTS:
        new = F.broadcast(new)
    at, own = private(table, "_at", "_new")
    joined = table.join(new.select(F.col("row").alias(at), F.col("_new").alias(own)), F.col(row) == F.col(at), "left")
    spans = F.when(F.col(own).isNull(), F.col("base_spans")).otherwise(F.array_sort(F.concat("base_spans", own)))
    return joined.withColumn("spans", spans).drop(at, own)


def spanned(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and others) without their text, with spans: an array of start, rank (of the kind), end and kind,
    sorted; base_spans are those of KINDS alone.

    A null or empty text has none. Repeated rows have the same spans each; extra columns
    stay, but those named as the results give way. An empty table gives no rows.
    """
    table, new, row, key = _found(docs.drop("base_spans", "spans"))
    return _with_new(table, new, row).drop(row, key)


def as_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def runs_of(spans: DataFrame) -> DataFrame:
    """key and runs: the merged overlapping spans of rows of key and x (a span), in order, each of its first span's kind."""
    order = Window.partitionBy("key").orderBy("start", "rank", "end")
    each = spans.select("key", "x.*").withColumn("reached", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    numbered = each.withColumn("run", F.sum(F.when(F.col("start") < F.col("reached"), 0).otherwise(1)).over(order))
    merged = numbered.groupBy("key", "run").agg(F.min(F.struct("start", "rank", "kind")).alias("first"), F.max("end").alias("end"))
    return merged.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col("first.start").alias("start"), "end", F.col("first.kind").alias("kind")))).alias("runs"))


def _without(text: Column, runs: Column, blocks: Column) -> Column:
    """text with runs replaced; blocks are the text's, so that each cut reads only the blocks that it goes over."""
    until = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["end"])

    def cut(a: Column, b: Column) -> Column:
        first = F.floor(a / TEXT_BLOCK).cast("int")
        over = F.array_join(F.slice(blocks, first + 1, F.ceil(b / TEXT_BLOCK).cast("int") - first), "")
        return F.when(b > a, F.substring(over, a - first * TEXT_BLOCK + 1, b - a)).otherwise(F.lit(""))

    pieces = F.transform(runs, lambda x, i: F.concat(cut(until(i), x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    return F.concat(F.array_join(pieces, ""), cut(until(F.size(runs)), F.length(text)))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each run of overlapping spans of text replaced by its first kind in brackets.

    A null text stays null, an empty one empty; repeated rows are replaced alike; all other columns stay. An empty
    table gives no rows. Texts are joined with their runs by two hashes: a broadcast up to
    BROADCAST_TEXTS, else a shuffle of the texts that hold a digit or an @.
    """
    table, new, row, key = _found(docs.select("text"))
    every = _with_new(table, new, row).where(F.size("spans") > 0).select(F.col(key).alias("key"), F.explode("spans").alias("x")).distinct()
    runs = written(runs_of(every), "runs")
    discarded(new)
    h, h2, own, blocks = private(docs, "_h", "_h2", "_runs", "_blocks")
    hashed = docs.withColumns({h: F.xxhash64("text"), h2: F.xxhash64(F.lit(2), "text")})
    runs_here = runs.select(F.col("key.h").alias(h), F.col("key.h2").alias(h2), F.col("runs").alias(own))
    if runs.count() <= BROADCAST_TEXTS:
        joined = hashed.join(F.broadcast(runs_here), [h, h2], "left")
    else:
        may = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
        joined = hashed.where(may).join(runs_here, [h, h2], "left").unionByName(hashed.where(~may).withColumn(own, F.lit(None).cast(runs.schema["runs"].dataType)))
    joined = joined.withColumn(blocks, F.when(F.col(own).isNotNull(), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))))
    replaced = F.when(F.col(own).isNotNull(), _without(F.col("text"), F.col(own), F.col(blocks))).otherwise(F.col("text"))
    return joined.withColumn("text", replaced).select(*docs.columns)


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of spanned; nulls, empty texts, repeated rows and empty tables as there."""
    found = spanned(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [F.size(F.filter("base_spans", partial(_is_kind, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text("base_spans"), 256).alias("base_sha256"), as_text("spans").alias("spans"))
