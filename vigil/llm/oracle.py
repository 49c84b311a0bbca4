"""DuckDB SQL for the queries that SQL can express, written from the definitions, not from the operators."""

ORACLE: dict[str, str] = {}

UP, LO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE["op8_mix_sources"] = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY (source IS NULL), source) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap, CASE k % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s),
b AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS budget FROM s),
l AS (SELECT a.source, a.cap, a.w, ((SELECT budget FROM b) - coalesce((SELECT sum(c.cap) FROM w c WHERE (c.cap / c.w, c.k) < (a.cap / a.w, a.k)), 0))
             / (SELECT sum(c.w) FROM w c WHERE (c.cap / c.w, c.k) >= (a.cap / a.w, a.k)) AS lev FROM w a),
t AS (SELECT w.source, w.source_size, least(w.cap, coalesce((SELECT max(lev) FROM l WHERE lev <= l.cap / l.w), CAST('inf' AS DOUBLE)) * w.w) AS target FROM w),
p AS (SELECT d.*, t.source_size, t.target, md5(CAST(doc_id AS VARCHAR)) AS h,
             sum(size) OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT p.*, turn, (upto + turn * source_size)::DOUBLE / target AS finish FROM p, (VALUES (0), (1)) AS v(turn) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id, source, turn, size ROWS UNBOUNDED PRECEDING) AS spent FROM q),
x AS (SELECT doc_id, source, count(*) AS times FROM r WHERE spent <= (SELECT budget FROM b) GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(p.size * coalesce(x.times, 0) AS BIGINT) AS taken
FROM p LEFT JOIN x ON p.doc_id = x.doc_id AND p.source IS NOT DISTINCT FROM x.source
"""

ORACLE["op9_decontaminate"] = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UP}', '{LO}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, '{UP}', '{LO}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, k, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

ORACLE["op1_format_chats"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(len('<|im_start|>') + len(role) + 1 + len(text) + len(regexp_extract_all(text, '<\\*\|')) + len('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLE["op3_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

ORACLE["op2_ngram_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UP}', '{LO}'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id)
"""


def _find(kind: int, pattern: str, group: int, test: str) -> str:
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind} AS k, start, start + len(m) AS stop, v FROM (
  SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v,
         unnest(list_transform(range(1, len(ms) + 1), lambda i: coalesce(list_sum(list_transform(gaps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0))) AS start
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs, string_split_regex(t, '{pattern}') AS gaps FROM d)) WHERE {test}"""


# What counts as a secret by its form, a run that may be one, an ordinary identifier, and the margins of the ratio.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS, _HEX, _RUN = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9+/=_-]{16,}"
_ORDINARY = "^([A-Z]?[a-z]+|[A-Z]+)([_-]([A-Z]?[a-z]+|[A-Z]+))*$"
_RANDOM = "SELECT v, 1 AS random FROM base UNION ALL SELECT v, 0 FROM runs WHERE regexp_matches(v, '" + _ORDINARY + "')"
_PAIR = "(ascii(v[i]) * 128 + ascii(v[i + 1]))"
ORACLE["op6_secrets"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({_find(0, _ASSIGN, 2, "len(v) >= 12")} UNION ALL {_find(1, _ACCESS, 0, "true")} UNION ALL {_find(2, _HEX, 0, "true")}),
cand AS ({_find(3, _RUN, 0, "true")}),
runs AS MATERIALIZED (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c.stop AND c.start < b.stop)),
pairs AS (SELECT {_PAIR} AS code, random FROM (SELECT v, random, unnest(range(1, len(v))) AS i FROM ({_RANDOM}))),
grid AS (SELECT g.code, g.code // 128 AS a, g.code % 128 AS b, coalesce(sum(random), 0) AS r, coalesce(sum(1 - random), 0) AS o
         FROM (SELECT unnest(range(0, 16384)) AS code) g LEFT JOIN pairs USING (code) GROUP BY ALL),
model AS (SELECT code, ln((r + 16.0::DOUBLE * (sum(r) OVER (PARTITION BY b) + 1) / (sum(r) OVER () + 64)) / (sum(r) OVER (PARTITION BY a) + 16.0::DOUBLE))
                      - ln((o + 16.0::DOUBLE * (sum(o) OVER (PARTITION BY b) + 1) / (sum(o) OVER () + 64)) / (sum(o) OVER (PARTITION BY a) + 16.0::DOUBLE)) AS v FROM grid),
scored AS (SELECT doc_id, start, stop, len(x.v) AS n, sum(model.v) AS s FROM (SELECT *, {_PAIR} AS code FROM (SELECT *, unnest(range(1, len(v))) AS i FROM runs)) x JOIN model USING (code) GROUP BY doc_id, start, stop, n),
al AS (SELECT doc_id, k, start, stop FROM base UNION ALL SELECT doc_id, 3, start, stop FROM scored WHERE s >= greatest(8.0, 0.25 * n)),
w AS (SELECT *, (['assign', 'access', 'hex', 'markov'])[k + 1] || ':' || start || ':' || stop AS s FROM al),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             coalesce(string_agg(s, ',' ORDER BY start, k) FILTER (k < 3), '') AS base, string_agg(s, ',' ORDER BY start, k) AS spans FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

ORACLE["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '@UP', '@LO'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
t AS (SELECT row, lang, source, unnest(words) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 2)) // (coalesce(g.n, 0) + 2 * l.v) AS p, 1 + (1000000000 * (k.n + 2)) // (l.n + 2 * l.v) AS q
      FROM s JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
      LEFT JOIN g ON g.lang = s.lang AND g.source = s.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
""".replace("@UP", UP).replace("@LO", LO)

#: CRC-32 by bits, as the SQL dialect has no such function: the divisor is a fixed value.
ORACLE["op12_periodic_runs"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
crc AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS bit, 4294967295::BIGINT AS r FROM d WHERE doc_id IS NOT NULL
        UNION ALL
        SELECT doc_id, s, bit + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
        FROM (SELECT doc_id, s, bit, CASE WHEN bit % 8 = 0 THEN xor(r, ord(s[bit // 8 + 1])::BIGINT) ELSE r END AS x FROM crc WHERE bit < 8 * length(s))),
h AS (SELECT doc_id, xor(r, 4294967295::BIGINT) AS h FROM crc WHERE bit = 8 * length(s)),
m AS (SELECT row, doc_id, words, len(words) AS n, h.h // 10 AS g, h.h % 10 = 0 AND len(words) > 0 AS change FROM d LEFT JOIN h USING (doc_id)),
a AS (SELECT *, CASE WHEN change THEN g % n END AS a FROM m),
b AS (SELECT *, CASE WHEN change THEN 1 + (n - a) // (3 + g % 8) END AS p FROM a),
e AS (SELECT row, doc_id, n, CASE WHEN change THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % p + 1] END) ELSE words END AS w FROM b),
-- Eight words that come again q words on; a run is a stretch of neighbours with the same q.
f AS (SELECT row, i, w[i + 1: i + 8] AS f FROM e, unnest(range(greatest(n - 7, 0))) AS r(i)),
j AS (SELECT x.row, x.i, y.i - x.i AS q FROM f x JOIN f y ON x.row = y.row AND x.f = y.f AND x.i < y.i),
o AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS stretch FROM j),
z AS (SELECT row, q, min(i) AS start, count(*) + 7 + q AS length FROM o GROUP BY row, q, stretch),
u AS (SELECT row, start, length, min(q) AS period FROM z WHERE length >= greatest(24, 3 * q) GROUP BY row, start, length),
runs AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS written,
                list({'s': start, 'l': length, 'q': period} ORDER BY start, period) AS all_runs FROM u GROUP BY row),
best AS (SELECT row, start, length, period FROM u x WHERE NOT EXISTS (SELECT 1 FROM u y WHERE y.row = x.row AND (y.length * x.period > x.length * y.period
         OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period))))),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM u),
cut AS (SELECT row, list(i) AS gone FROM gone GROUP BY row)
SELECT e.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
       CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(written, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(n)), lambda v: NOT list_contains(gone, v[2])), lambda v: v[1]) END, ' ')) AS collapsed_sha256
FROM e LEFT JOIN runs USING (row) LEFT JOIN best USING (row) LEFT JOIN cut USING (row)
"""
