"""DuckDB SQL for the queries that SQL can express, over the same whole tables.

No SQL is given for XXH64 votes (op3), the trained models (op1, op4, op10), the
entropy windows (op6) and tokenisation (op9); tests hold those against brute force.
"""

from __future__ import annotations

from churnspark.llm.common import LOWER, UPPER
from churnspark.llm.decontamination import WORD
from churnspark.llm.divergence_audit import SCALE, TERM
from churnspark.llm.quality_rules import BOILERPLATE, END_MARKS, MARKS
from churnspark.llm.quartile_digest import BOUND, BUCKETS, COST, FACTORS, HEADER_COST, LENGTH_STEPS, STEP, TRIPLETS

SPACED = r"[^\x20\x09-\x0D]+"

OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, s, s + least(len(w), 13) - 1), ' ') AS x
       FROM i, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
ds AS (SELECT doc_id, w, n FROM d, sizes),
dw AS (SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS x FROM ds, unnest(range(1, len(w) - n + 2)) AS u(s)),
hits AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.x = iw.x),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + n)) AS u(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id"""

OP5 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS x FROM d, unnest(range(1, len(w) - 18)) AS u(s)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(range(s, s + 20)) AS u(p)),
word AS (SELECT doc_id, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS n FROM word ANTI JOIN gone
         ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

_END_LIST = ", ".join("'" + c.replace("'", "''") + "'" for c in END_MARKS)
_ANY_MARK = " OR ".join(f"contains(line, '{c}')" for c in MARKS)
_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)

OP7 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
win AS (SELECT doc_id, s, w[s] || ' ' || w[s + 1] || ' ' || w[s + 2] AS x FROM d, unnest(range(1, len(w) - 1)) AS u(s)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM
        (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, x) AS k FROM win) AS a, unnest(range(s, s + 3)) AS u(p) WHERE k > 1 GROUP BY doc_id),
ls AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
lw AS (SELECT doc_id, i, line, regexp_extract_all(line, '{SPACED}') AS w FROM ls),
own AS (SELECT *, len(w) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup FROM lw WHERE len(w) > 0),
judged AS (SELECT *, len([x for x in w if x = '|']) >= 0.2 * n OR (n <= 3 AND right(rtrim(line), 1) NOT IN ({_END_LIST}))
    OR NOT ({_ANY_MARK}) OR len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.1 * n
    OR (contains(line, '!!') AND 2 * len([x for x in w if ends_with(x, '!!')]) >= n)
    OR (n >= 10 AND 3 * len(list_distinct(w)) < n) OR ({_PHRASES}) AS bad FROM own),
per AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup, count(*) FILTER (bad) AS n_bad,
               coalesce(sum(n) FILTER (bad), 0) AS lost FROM judged GROUP BY doc_id),
full_ AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - len(regexp_extract_all(t, '[\\x20\\x09-\\x0D]')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_bad, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
    FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 10 * n_lost_words <= 3 * n_words AS kept FROM full_"""

OP8 = f"""
WITH ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h FROM ls),
r AS (SELECT doc_id, i, line, xor(xor(h, coalesce(lag(h, 1) OVER o >> 1, 0)), coalesce(lag(h, 2) OVER o >> 2, 0)) % 3 = 0 AS cut
      FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(CAST(cut AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM r),
g AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n, min(i) AS start,
             count(*) FILTER (len(regexp_extract_all(line, '{SPACED}')) > 0) AS full_lines FROM c GROUP BY doc_id, chunk),
m AS (SELECT *, full_lines > 1 AND row_number() OVER (PARTITION BY body, full_lines > 1 ORDER BY doc_id, start) > 1 AS gone FROM g),
k AS (SELECT doc_id, sum(n) AS n_lines, coalesce(sum(n) FILTER (gone), 0) AS n_removed, count(*) FILTER (gone) AS n_chunks,
             string_agg(body, chr(10) ORDER BY start) FILTER (NOT gone) AS t FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_chunks, 0) AS BIGINT) AS n_chunks, CASE WHEN text IS NOT NULL THEN CAST(length(coalesce(t, '')) AS BIGINT) END AS kept_chars,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents AS d LEFT JOIN k ON d.doc_id = k.doc_id"""

_COST_LIST = "[" + ", ".join(map(str, COST)) + "]"
_TRIPLE_HASHES = " UNION ALL ".join(
    f"SELECT side, doc_id, (b[s] * {FACTORS[0]} + b[s + {i}] * {FACTORS[1]} + b[s + {j}] * {FACTORS[2]} + {k * STEP % (1 << 32)})"
    f" % 4294967296 // 16777216 AS h FROM bytes, unnest(range(1, len(b) - {j} + 1)) AS u(s)" for k, (i, j) in enumerate(TRIPLETS))


def _score(a: str, b: str) -> str:
    """The bounded difference of two digest rows."""
    return f"""least({BOUND}, {HEADER_COST} * (least({LENGTH_STEPS}, abs({a}.len - {b}.len)) + abs({a}.r1 - {b}.r1) + abs({a}.r2 - {b}.r2))
        + list_sum(list_transform(list_zip({a}.codes, {b}.codes), lambda z: {_COST_LIST}[1 + abs(z[1] - z[2])])))"""


OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(doc_id) OVER o, min(doc_id) OVER ()) AS next_id, coalesce(lead(t) OVER o, first_value(t) OVER o) AS next_t
      FROM d WINDOW o AS (ORDER BY doc_id)),
texts AS (SELECT 0 AS side, doc_id, t FROM n UNION ALL
          SELECT 1, doc_id, left(t, length(t) - length(t) // 4) || left(next_t, length(t) // 4) FROM n),
bytes AS (SELECT side, doc_id, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM texts),
hits AS ({_TRIPLE_HASHES}),
cells AS (SELECT side, doc_id, h, 0 AS n FROM texts, unnest(range({BUCKETS})) AS u(h) UNION ALL
          SELECT side, doc_id, h, count(*) FROM hits GROUP BY ALL),
counts AS (SELECT side, doc_id, h, sum(n) AS n FROM cells GROUP BY ALL),
lists AS (SELECT side, doc_id, list(n ORDER BY h) AS c, list_sort(list(n)) AS s FROM counts GROUP BY ALL),
marks AS (SELECT side, doc_id, c, s[{BUCKETS // 4}] AS q1, s[{BUCKETS // 2}] AS q2, s[{3 * BUCKETS // 4}] AS q3 FROM lists),
prints AS (SELECT m.side, m.doc_id, list_transform(c, lambda x: CAST(x > q1 AS INT) + CAST(x > q2 AS INT) + CAST(x > q3 AS INT)) AS codes,
           least(15, 16 * q1 // greatest(q3, 1)) AS r1, least(15, 16 * q2 // greatest(q3, 1)) AS r2,
           CASE WHEN strlen(t) = 0 THEN 0 ELSE 8 * length(bin(strlen(t))) + CAST('0b' || rpad(substr(bin(strlen(t)), 2, 3), 3, '0') AS INT) END AS len
           FROM marks AS m JOIN texts USING (side, doc_id)),
shown AS (SELECT *, printf('%02x', CAST(len AS INT)) || printf('%x', CAST(r1 AS INT)) || printf('%x', CAST(r2 AS INT)) || array_to_string(list_transform(
          range(1, {BUCKETS}, 2), lambda i: printf('%x', CAST(4 * codes[i] + codes[i + 1] AS INT))), '') AS fp FROM prints)
SELECT n.doc_id, CAST(length(n.t) AS BIGINT) AS n_chars, sha256(e.t) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
       1.0::DOUBLE - {_score('a', 'b')}::DOUBLE / {BOUND} AS near_edited, 1.0::DOUBLE - {_score('a', 'c')}::DOUBLE / {BOUND} AS near_next
FROM n JOIN texts AS e ON e.side = 1 AND e.doc_id = n.doc_id JOIN shown AS a ON a.side = 0 AND a.doc_id = n.doc_id
JOIN shown AS b ON b.side = 1 AND b.doc_id = n.doc_id JOIN shown AS c ON c.side = 0 AND c.doc_id = n.next_id"""

_NEAREST = """a{r} AS MATERIALIZED (SELECT vec_id, v, c AS cluster, dist AS distance, cv FROM (SELECT vec_id, v, c, cv,
    list_sum(list_transform(list_zip(v, cv), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist FROM kept, c{r})
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) = 1)"""
_MOVED = """c{n} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.cv, c{r}.cv) AS cv FROM c{r} LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS cv FROM (
    SELECT cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM a{r}, unnest(range(1, 65)) AS u(i) GROUP BY ALL) GROUP BY cluster) AS m ON m.cluster = c{r}.c)"""

OP12 = f"""
WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v AS cv FROM kept
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
{", ".join(_NEAREST.format(r=r) + ", " + _MOVED.format(r=r, n=r + 1) for r in range(3))},
{_NEAREST.format(r=3)}
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(cv, ',')) AS centroid_sha256 FROM a3"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
own AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
size AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups AS g LEFT JOIN own USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + {SCALE}::HUGEINT * (coalesce(o.n, 0) + 1) // (g.total + l.v) AS p,
             1 + {SCALE}::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
      FROM size AS g JOIN langs AS l USING (lang) JOIN kept AS k USING (lang) LEFT JOIN own AS o USING (lang, source, term)),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value,
          row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term) AS rank FROM p WHERE n > 0 AND p > q QUALIFY rank <= 200),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM (
    SELECT * FROM terms UNION ALL
    SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs)"""

ORACLE = {"op2_decontamination": OP2, "op5_substring_dedup": OP5, "op7_quality_rules": OP7, "op8_line_dedup": OP8,
          "op11_quartile_digest": OP11, "op12_drift_kmeans": OP12, "op13_source_divergence": OP13}
