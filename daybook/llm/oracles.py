"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {}

ORACLE["op3_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('29:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS ord
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS s, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY 3.0 * s / w, source NULLS LAST) AS k FROM src),
levels AS (   -- level if exactly the first k - 1 sources (by size per weight) are clamped
  SELECT k, (SELECT sum(s) FROM src) - coalesce(3 * sum(s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, s, w
  FROM ranked),
level AS (SELECT rest, free FROM levels WHERE w::DOUBLE * rest / free <= 3 * s ORDER BY k LIMIT 1),
target AS (
  SELECT source, s, least(w::DOUBLE * rest::DOUBLE / free::DOUBLE, (3 * s)::DOUBLE) AS t FROM src LEFT JOIN level ON true),
parts AS (SELECT *, CASE WHEN s > 0 THEN floor(t / s)::INT ELSE 0 END AS whole FROM target),
walk AS (
  SELECT z.doc_id, z.size, p.s, p.t, p.whole, p.t - p.whole * p.s AS missing,
         sum(z.size) OVER (PARTITION BY z.source ORDER BY z.ord, z.doc_id, z.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized z JOIN parts p ON z.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, coalesce(t, 0.0) AS target,
       ((whole + CASE WHEN upto - size / 2.0 <= missing THEN 1 ELSE 0 END) * size)::BIGINT AS taken  -- size 0 takes nothing
FROM walk
"""

ORACLE["op9_cell_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS c FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.c = l.a),
component AS (SELECT a, min(c) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.c, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(c.c, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN component c ON c.a = e.vec_id
"""

ORACLE["op6_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
stripped AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM split),
numbered AS (
  SELECT *, CASE WHEN s <> '' THEN row_number() OVER (PARTITION BY doc_id, s <> '' ORDER BY n) END AS pos FROM stripped),
counted AS (SELECT doc_id, pos, s, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS n FROM numbered WHERE s <> ''),
seq AS (
  SELECT *, lead(s, 1) OVER w AS s1, lead(n, 1) OVER w AS n1, lead(s, 2) OVER w AS s2 FROM counted
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
three AS (SELECT doc_id, pos, min({'d': doc_id, 'p': pos}) OVER (PARTITION BY s, s1, s2) AS first FROM seq WHERE s2 IS NOT NULL),
two AS (SELECT doc_id, pos, min({'d': doc_id, 'p': pos}) OVER (PARTITION BY s, s1) AS first FROM seq
        WHERE n < 50 AND n1 < 50 AND n + n1 >= 50),   -- a passage wrapped into two lines
one AS (SELECT doc_id, pos, min({'d': doc_id, 'p': pos}) OVER (PARTITION BY s) AS first FROM seq WHERE n >= 50),
gone AS (
  SELECT doc_id, pos + unnest([0, 1, 2]) AS pos FROM three WHERE first <> {'d': doc_id, 'p': pos}
  UNION
  SELECT doc_id, pos + unnest([0, 1]) AS pos FROM two WHERE first <> {'d': doc_id, 'p': pos}
  UNION
  SELECT doc_id, pos FROM one WHERE first <> {'d': doc_id, 'p': pos}),
kept AS (
  SELECT n.doc_id, count(g.pos) AS removed, string_agg(n.line, chr(10) ORDER BY n.n) FILTER (g.pos IS NULL) AS text,
         bool_or(n.s <> '' AND g.pos IS NULL) AS any_left
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.pos = g.pos GROUP BY n.doc_id)
SELECT d.doc_id, coalesce(k.removed, 0)::INT AS lines_removed,
       CASE WHEN coalesce(k.removed, 0) = 0 THEN d.text WHEN k.any_left THEN k.text ELSE '' END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

ORACLE["op4_warc"] = r"""
WITH alphabet AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a),
payload AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
summed AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS sha FROM payload),
bits AS (   -- base32: 160 bits of the digest in groups of five
  SELECT *, list_aggregate(list_transform(range(0, 32), lambda g: a[(
      (('0x' || sha[(g * 5 // 4) + 1] || coalesce(nullif(sha[(g * 5 // 4) + 2], ''), '0'))::INT >> (3 - g * 5 % 4)) & 31)::INT + 1]),
      'string_agg', '') AS digest
  FROM summed, alphabet),
latest AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS m FROM bits)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM latest
"""

ORACLE["op13_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
single AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM numbered),
followed AS (SELECT *, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM single WINDOW o AS (PARTITION BY id ORDER BY i)),
grams AS (
  SELECT lang, 1 AS words, w1 AS phrase FROM followed
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM followed WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM followed WHERE w3 IS NOT NULL),
counted AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE words = 1 GROUP BY lang),
candidate AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE words >= 2 AND f >= 10),
inside AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidate WHERE words = 3),
covered AS (SELECT DISTINCT c.lang, c.phrase FROM candidate c JOIN inside t USING (lang, phrase) WHERE 100 * t.a >= 50 * c.a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM candidate c JOIN range(1, 3) AS t(k) ON k < c.words
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  ANTI JOIN covered v ON v.lang = c.lang AND v.phrase = c.phrase),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM best b JOIN total t ON t.lang = b.lang
QUALIFY rank <= 2000
"""
