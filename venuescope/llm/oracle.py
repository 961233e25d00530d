"""DuckDB SQL of the queries that SQL can express, over the whole input tables."""

#: {query: SQL}
SQL: dict[str, str] = {}

SQL["op3_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, line, i, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents) AS u),
shared AS (SELECT key, max(doc_id) AS owner FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT l.*, coalesce(s.owner <> l.doc_id, false) AS gone FROM lines l LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SQL["op11_phrases"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
numbered AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT p, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered),
spans AS (SELECT lang, w1, lead(w1, 1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM words WINDOW s AS (PARTITION BY p ORDER BY i)),
counts AS (
  SELECT lang, 1 AS k, w1 AS phrase, w1, '' AS w2, '' AS w3, count(*) AS f FROM spans GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, w1, w2, '', count(*) FROM spans WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, count(*) FROM spans WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, f AS a FROM counts WHERE k > 1 AND f >= 10),
sides AS (
  SELECT lang, phrase, a, 1 AS j, w1 AS lp, CASE k WHEN 2 THEN w2 ELSE w2 || ' ' || w3 END AS rp FROM cand
  UNION ALL SELECT lang, phrase, a, 2, w1 || ' ' || w2, w3 FROM cand WHERE k = 3),
cuts AS (
  SELECT s.lang, s.phrase, s.a, s.j, l.f AS l, r.f AS r, (CAST(1000000 AS HUGEINT) * s.a * s.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM sides s JOIN counts l ON l.lang = s.lang AND l.phrase = s.lp JOIN counts r ON r.lang = s.lang AND r.phrase = s.rp),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
around AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, a FROM cand WHERE k = 3 UNION ALL SELECT lang, w2 || ' ' || w3, a FROM cand WHERE k = 3) AS u GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN around i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL["op10_embedding_dedup"] = r"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM good),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM unit a JOIN unit b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x),
least_ AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, least(v.vec_id, coalesce(y, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(y, v.vec_id) AS kept
FROM embeddings v LEFT JOIN n ON n.x = v.vec_id LEFT JOIN least_ m ON m.x = v.vec_id
"""
