"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS n,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT src, CAST(sum(n) AS BIGINT) AS size FROM d GROUP BY src),
w AS (SELECT src, size, 3 * size AS cap,
             [5, 2, 1][CAST((row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS INT)] AS weight FROM s),
f AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS full_before, coalesce(sum(weight) OVER o, 0) AS gone
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT max((CAST((SELECT sum(size) FROM s) AS DOUBLE) - CAST(full_before AS DOUBLE))
             / CAST((SELECT sum(weight) FROM w) - gone AS DOUBLE)) AS level FROM f),
t AS (SELECT src, size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM f, l),
p AS (
  SELECT d.*, t.size AS whole, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(n) OVER (PARTITION BY d.src ORDER BY k, doc_id, n
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t USING (src))
SELECT doc_id, CAST(n AS BIGINT) AS size, whole AS source_size, target,
       CAST(CASE WHEN whole = 0 THEN 0
            ELSE budget // whole * n + greatest(0, least(n, budget % whole - before)) END AS BIGINT) AS taken
FROM p
"""


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one kind: matches and the gaps between them, as running sums of lengths."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT id, {number} AS number, '{kind}' AS kind, start, start + n AS stop FROM (
    SELECT id, unnest(m) AS n, unnest(k) AS size,
           unnest(list_transform(range(1, len(m) + 1),
             lambda i: list_sum(g[1:i]) + coalesce(list_sum(m[1:i - 1]), 0))) AS start
    FROM (
      SELECT id, list_transform(regexp_extract_all(text, '{quoted}'), lambda x: length(x)) AS m,
             list_transform(regexp_extract_all(text, '{quoted}', {group}), lambda x: length(x)) AS k,
             list_transform(regexp_split_to_array(text, '{quoted}'), lambda x: length(x)) AS g
      FROM d WHERE regexp_matches(text, '{quoted}')))
  WHERE size >= {least}"""


#: The rules of the secret scan.
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
)

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_spans(i, *r) for i, r in enumerate(RULES))}),
a AS (
  SELECT id, count(*) FILTER (number = 0) AS n_assign, count(*) FILTER (number = 1) AS n_access,
         count(*) FILTER (number = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) FILTER (number < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans
  FROM s GROUP BY id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (id)
"""

OP2 = """
WITH r AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
q AS (SELECT vec_id, max(v) AS v FROM r WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM q, r c WHERE q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS m FROM s),
f AS (SELECT lang, w[i : i + m - 1] AS words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
longer AS (
  SELECT lang, words, max(f) AS most FROM (
    SELECT lang, words[1 : len(words) - 1] AS words, f FROM f WHERE len(words) > 2
    UNION ALL SELECT lang, words[2 : len(words)], f FROM f WHERE len(words) > 2) GROUP BY ALL),
c AS (
  SELECT f.lang, f.words, f.f AS a, unnest(range(1, len(f.words))) AS k
  FROM f LEFT JOIN longer USING (lang, words) WHERE len(f.words) > 1 AND coalesce(most, 0) < f.f),
cuts AS (
  SELECT c.*, x.f AS l, y.f AS r, n.n,
         CAST((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.words = c.words[1 : k]
  JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1 : len(c.words)] JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
o AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score FROM best)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM o QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
i AS (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM s),
x AS (SELECT DISTINCT item, m, array_to_string(w[k : k + m - 1], ' ') AS words FROM i),
p AS (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM x) WHERE len(w) >= m),
h AS (SELECT p.id, p.k, p.m, x.item FROM p JOIN x ON x.m = p.m AND x.words = array_to_string(p.w[p.k : p.k + p.m - 1], ' ')),
n AS (SELECT id, count(DISTINCT place) AS n_hit FROM (SELECT id, unnest(range(k, k + m)) AS place FROM h) GROUP BY id),
o AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT id, item FROM h WHERE item IS NOT NULL) GROUP BY id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (id) LEFT JOIN o USING (id)
"""

SQL = {
    "op1_mix_sources": OP1,
    "op2_exact_top_k": OP2,
    "op8_secret_scan": OP8,
    "op11_collocations": OP11,
    "op13_decontamination": OP13,
}
