"""DuckDB SQL for the queries whose rows SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), hot AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id <> h.last_doc AS gone
  FROM keyed k LEFT JOIN hot h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), singles AS (
  SELECT lang, unnest(w) AS p FROM listed
), ones AS (
  SELECT lang, p, count(*) AS f FROM singles GROUP BY ALL
), twos AS (
  SELECT lang, a, b, count(*) AS f FROM (
    SELECT lang, unnest(w[:-2]) AS a, unnest(w[2:]) AS b FROM listed WHERE len(w) >= 2) GROUP BY ALL
), threes AS (
  SELECT lang, a, b, c, count(*) AS f FROM (
    SELECT lang, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c
    FROM listed WHERE len(w) >= 3) GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang
), cuts AS (
  SELECT t.lang, t.a || ' ' || t.b AS phrase, t.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.a JOIN ones y ON y.lang = t.lang AND y.p = t.b
  WHERE t.f >= 10 AND NOT EXISTS (
    SELECT 1 FROM threes s WHERE s.lang = t.lang AND 100 * s.f >= 50 * t.f
      AND ((s.a = t.a AND s.b = t.b) OR (s.b = t.a AND s.c = t.b)))
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.a, t.b, t.c), t.f, x.f, y.f, 1
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.a
  JOIN twos y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, concat_ws(' ', t.a, t.b, t.c), t.f, x.f, y.f, 2
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b
  JOIN ones y ON y.lang = t.lang AND y.p = t.c
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM least JOIN totals USING (lang) WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES["op11_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), own AS (
  SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT d.lang, d.source FROM docs d
), totals AS (
  SELECT g.lang, g.source, coalesce(sum(o.c), 0) AS n FROM groups g LEFT JOIN own o USING (lang, source)
  GROUP BY ALL
), p AS (
  SELECT t.lang, t.source, k.term, coalesce(o.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(o.c, 0) + 1)) // (t.n + s.v) AS p
  FROM totals t JOIN sizes s USING (lang) JOIN kept k USING (lang)
  LEFT JOIN own o ON o.lang = t.lang AND o.source = t.source AND o.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), q AS (
  SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.c + 1)) // (s.n + s.v) AS q
  FROM kept k JOIN sizes s USING (lang)
), term AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
