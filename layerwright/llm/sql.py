"""SQL with the same results, for the queries that SQL can express on whole tables."""

from __future__ import annotations

_SHARE, _WINDOW = 20, 13
_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"

SQLS = {
    "op4_suffix_automaton_decontamination": f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
piece AS (
  SELECT DISTINCT item_id, least(len(w), {_WINDOW}) AS size,
         unnest(list_transform(range(1, len(w) - least(len(w), {_WINDOW}) + 2),
                               lambda i: list_aggregate(w[i:i + least(len(w), {_WINDOW}) - 1], 'string_agg', ' '))) AS run
  FROM item WHERE len(w) > 0),
doc AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM piece),
runs AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
         unnest(list_transform(range(1, len(w) - size + 2), lambda i: list_aggregate(w[i:i + size - 1], 'string_agg', ' '))) AS run
  FROM doc, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, runs.pos, runs.size, item_id FROM runs JOIN piece USING (size, run)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
         FROM found GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(held.n, 0) AS BIGINT) AS n_items, sha256(coalesce(held.ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND {_SHARE} * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""",
    "op6_partenum_jaccard": """
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM doc WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM meet JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * meet.n >= 85 * (x.n + y.n - meet.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, least_id.b AS component_id
FROM doc LEFT JOIN size USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) least_id ON least_id.a = doc.doc_id""",
    "op10_warc_index_first": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, html, max(page_id) OVER (PARTITION BY html) AS best FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM r""",
}
