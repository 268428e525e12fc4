"""SQL counterparts of the corpus queries that DuckDB can express.

The others rest on a trained model, a schedule, a tokenizer or reachability; tests hold
them against plain Python.
"""

from __future__ import annotations

_SPACE = r"\x20\x09-\x0D"

ORACLE: dict[str, str] = {
    "op8_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS k FROM lines
), shared AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT doc_id, place, line, k IN (SELECT k FROM shared) AS gone FROM keyed
)
SELECT d.doc_id,
       CASE WHEN d.text IS NOT NULL THEN coalesce(m.kept, '') END AS text,
       CAST(coalesce(m.n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(m.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id
) m USING (doc_id)""",
    "op2_decontamination": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0
), doc_windows AS (
  SELECT doc_id, i, s.n, array_to_string(w[i:i + s.n - 1], ' ') AS win
  FROM doc, (SELECT DISTINCT n FROM item_windows) s, unnest(range(1, len(w) - s.n + 2)) AS r(i)
), hits AS (
  SELECT DISTINCT doc_id, i, d.n, item_id
  FROM doc_windows d JOIN item_windows b ON d.win = b.win AND d.n = b.n
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM hits) h, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), word AS (SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_count
  FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), held AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n
  FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL
), lang_size AS (
  SELECT lang, count(*) AS v, sum(lang_count) AS total FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM d
), group_size AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
  FROM groups g LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source GROUP BY ALL
), given AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (1000000000 * (coalesce(h.n, 0) + 2)) // (g.total + 2 * s.v) AS p,
         1 + (1000000000 * (k.lang_count + 2)) // (s.total + 2 * s.v) AS q
  FROM group_size g JOIN lang_size s USING (lang) JOIN kept k USING (lang)
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item,
         sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM given a JOIN given b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), found AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN pair p ON p.lang = g.lang AND p.source = g.source AND p.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM given WHERE n > 0 AND p > q
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM placed WHERE part = 'pair' OR place <= 10""",
    "op13_ranked_search": r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), size AS (
  SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS total FROM doc WHERE len(w) > 0
), held AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM doc) SEMI JOIN item USING (term) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt
  FROM held, size GROUP BY term, nd
), worth AS (
  SELECT doc_id, term, wt * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // total))) AS points
  FROM held JOIN weight USING (term), size
), score AS (
  SELECT item_id, doc_id, CAST(sum(points) AS BIGINT) AS score FROM worth JOIN item USING (term) GROUP BY ALL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM score WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 10""",
}
