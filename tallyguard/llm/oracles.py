"""SQL for the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

MINHASH = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i : i + 4] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * k >= 75 * (x.n + y.n - k)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept,
  coalesce(m.class_id, d.doc_id) AS class_id
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY gs) AS class_id
  FROM (SELECT doc_id, list(g ORDER BY g) AS gs FROM s GROUP BY doc_id)
) m USING (doc_id)
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
),
o AS MATERIALIZED (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(ts) AS term FROM d) GROUP BY ALL
),
k AS MATERIALIZED (SELECT lang, term, sum(n)::BIGINT AS n FROM o GROUP BY ALL HAVING count(*) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(s.n, 0)::BIGINT AS n
  FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM o GROUP BY ALL) s
    ON s.lang = g.lang AND s.source = g.source AND s.term = k.term
),
t AS (SELECT lang, source, sum(n)::BIGINT AS total FROM c GROUP BY ALL),
p AS MATERIALIZED (
  SELECT c.lang, c.source, term, c.n,
    1 + ((1000000000::HUGEINT * (c.n + 5)) // (t.total + 5 * l.v))::BIGINT AS p,
    1 + ((1000000000::HUGEINT * (c.lang_n + 5)) // (l.total + 5 * l.v))::BIGINT AS q
  FROM c JOIN t ON t.lang = c.lang AND t.source = c.source JOIN l ON l.lang = c.lang
),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM x
) WHERE part = 'pair' OR rank <= 50
"""

ORACLES: dict[str, str] = {
    "op1_minhash": MINHASH,
    "op9_exact_dedup": EXACT_DEDUP,
    "op13_source_divergence": DIVERGENCE,
}
