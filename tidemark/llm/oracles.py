"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

from tidemark.llm.quality import PRIOR_LEAST, PRIOR_MOST, SPREAD, TOLERATED

#: Failures by rule, over the figures of a document.
_RULES = {
    "symbols": "100 * n_symbols > 25 * n_words",
    "same_lines": "n_dup_lines >= 3 AND n_dup_lines * 20 > n_words",
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 14 * n_words)",
}
#: Slips by rule.
_SLIPS = {
    "symbols": "100 * n_symbols > 10 * n_words",
    "same_lines": "n_dup_lines >= 1 AND n_dup_lines * 40 > n_words",
    "word_length": "n_words > 0 AND (2 * word_chars < 7 * n_words OR word_chars > 12 * n_words)",
}
_SPACE = r"[ \t\n\x0B\f\r]"


def _verdicts() -> str:
    """Of each host and rule, whether the shrunk rate is over each limit."""
    out = []
    for r in _RULES:
        mean, sampling = f"(sum({r}) OVER () / sum(n) OVER ())", f"(sum({r}) OVER () / sum(n) OVER () * (1 - sum({r}) OVER () / sum(n) OVER ()) * count(*) OVER () / sum(n) OVER ())"
        between = f"(sum({r} * {r} / n) OVER () / sum(n) OVER () - {mean} * {mean} - {sampling})"
        weight = f"(CASE WHEN {between} > 0 THEN least({PRIOR_MOST}, greatest({PRIOR_LEAST}, {mean} * (1 - {mean}) / {between} - 1)) ELSE {PRIOR_MOST} END)"
        for name, sign in (("not_good", "-"), ("bad", "+")):
            limit = f"greatest({TOLERATED}, {mean} {sign} {SPREAD} * sqrt({mean} * (1 - {mean}) / ({weight} + 1)))"
            out.append(f"({r} + {weight} * {mean}) / (n + {weight}) > {limit} AS {name}_{r}")
    return ", ".join(out)


QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, source, t, list_filter(regexp_split_to_array(t, '{_SPACE}+'), lambda x: x <> '') AS words,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines FROM d),
windows AS (SELECT k, i, array_to_string(words[i : i + 4], ' ') AS win FROM (SELECT k, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
again AS (SELECT k, unnest(range(i, i + 5)) AS pos FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS c FROM windows) WHERE c > 1),
covered AS (SELECT k, count(DISTINCT pos) AS n FROM again GROUP BY k),
f AS (SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(covered.n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (k)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {", ".join(f"({c}) AS fails_{r}" for r, c in _RULES.items())}, {", ".join(f"({c}) AS slips_{r}" for r, c in _SLIPS.items())} FROM f),
hosts AS (SELECT source AS host, count(*)::DOUBLE AS n, {", ".join(f"sum(CAST(fails_{r} AS DOUBLE)) AS {r}" for r in _RULES)} FROM failed WHERE source IS NOT NULL GROUP BY source),
bad AS (SELECT host, {_verdicts()} FROM hosts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(f"(fails_{r} AND coalesce(not_good_{r}, FALSE)) OR (slips_{r} AND coalesce(bad_{r}, FALSE))" for r in _RULES)}) AS kept
FROM failed LEFT JOIN bad ON host = source
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINNOWING = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
items AS (SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM items),
windows AS (SELECT k, n, i, array_to_string(words[i : i + n - 1], ' ') AS win FROM (SELECT k, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)),
hits AS (SELECT k, i, n, item_id FROM windows JOIN items USING (n, win)),
words_hit AS (SELECT k, count(DISTINCT pos) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT k, i, n FROM hits)) GROUP BY k),
items_hit AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words_hit USING (k) LEFT JOIN items_hit USING (k)
"""

_CRC_TABLE = "(SELECT list(t ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(i)))"


def _crc32(codes: str) -> str:
    """The crc32 of a list of bytes, by the table t."""
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])))"


def _digits(number: str) -> str:
    return f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))"


COHORTS = f"""
WITH crc AS {_CRC_TABLE},
known AS (SELECT *, {_crc32(_digits("click_id"))} AS h FROM (SELECT DISTINCT * FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL), crc),
e AS (SELECT client_id, epoch_us(ts) AS us, kind, coalesce(CAST(floor(100 * value + 0.5) AS BIGINT), 0) AS cents,
  coalesce(arrived_at + CASE WHEN h % 3 = 0 THEN to_days(CAST(h % 100 AS INTEGER)) ELSE to_days(0) END < TIMESTAMP '2024-03-01', FALSE) AS early FROM known),
events AS (SELECT 0 AS state, * FROM e WHERE early UNION ALL SELECT 1, * FROM e),
starts AS (SELECT state, client_id, min(us) AS start, CAST(floor(floor(min(us) / 86400000000) / 3) AS BIGINT) AS cohort FROM events WHERE kind = 'purchase' GROUP BY ALL),
cities AS (SELECT client_id, min(city) AS city FROM clients GROUP BY client_id),
people AS (SELECT s.state, s.client_id, s.start, s.cohort, coalesce(c.city, '') AS segment, coalesce(o.cohort <> s.cohort, FALSE) AS moved, {_crc32(_digits("s.client_id"))} AS crc
  FROM starts s JOIN crc ON TRUE LEFT JOIN cities c ON c.client_id = s.client_id LEFT JOIN starts o ON o.client_id = s.client_id AND o.state = 1 - s.state),
seen AS (SELECT state, client_id, segment, cohort, moved, crc, (us - start) // 259200000000 AS period, sum(cents) AS cents FROM people JOIN events USING (state, client_id) WHERE us >= start GROUP BY ALL)
SELECT CAST(state AS INTEGER) AS state, segment, cohort, CAST(period AS BIGINT) AS period, count(*) AS users, CAST(sum(crc) AS BIGINT) AS users_crc32, CAST(sum(CAST(moved AS INTEGER)) AS BIGINT) AS moved, CAST(sum(cents) AS BIGINT) AS cents
FROM seen GROUP BY state, segment, cohort, period
"""

_TEXT_BYTES = "flatten(list_transform(string_split({s}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))"

SPELLING = f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
runs AS (SELECT k, doc_id, run, count(*) AS n FROM (SELECT k, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run
  FROM (SELECT row_number() OVER () AS k, doc_id, text FROM documents)) GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32(_TEXT_BYTES.format(s="coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h FROM runs, crc),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN run[: h % len(run)] || run[h % len(run) + 2 :] ELSE run END AS word FROM hashed) WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, i, word[: i] || word[i + 2 :] AS rest FROM (SELECT word, unnest(range(len(word))) AS i FROM v)),
shorter AS (SELECT DISTINCT cut.word AS long, rest AS short FROM cut JOIN v ON v.word = rest),
near AS (SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT long, short FROM shorter UNION SELECT short, long FROM shorter),
best AS (SELECT near.word AS word, count(*) AS n_near, arg_min(other, (-v.n, encode(other))) AS other, max(v.n) AS most FROM near JOIN v ON v.word = other GROUP BY near.word),
f AS (SELECT v.word AS word, v.n AS n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * v.n THEN other END AS form, CASE WHEN most >= 2 * v.n THEN most END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
walk AS (SELECT word, word AS reached, 0 AS step FROM f UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN f ON f.word = walk.reached WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(reached, step) AS root FROM walk GROUP BY word)
SELECT f.word AS word, form, root, n, n_near, form_n FROM f JOIN ends ON ends.word = f.word
"""
