"""DuckDB SQL that gives the rows of the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"

REPEATS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
m AS (SELECT k, min(doc_id) AS least FROM s GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM s JOIN m USING (k) WHERE least < doc_id),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

NEAR_COPIES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, {SPACED}) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) END AS s FROM w),
c AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT rep, n, unnest(s) AS g FROM c),
o AS (SELECT x.rep AS a, y.rep AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS o FROM e x JOIN e y ON x.g = y.g AND x.rep <> y.rep AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * o >= 90 * (n + m - o)),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
k AS (SELECT a AS rep, min(b) AS component FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(component, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.s = c.s LEFT JOIN k ON c.rep = k.rep
"""

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM p),
s AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
f AS (SELECT doc_id, s.size, i, item FROM s JOIN p ON s.k = p.k AND s.size = p.size),
h AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM f) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_fm_index": REPEATS, "op9_near_copies": NEAR_COPIES, "op10_decontamination": CONTAMINATION}
