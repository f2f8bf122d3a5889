"""SQL twins of the queries of this subpackage, for DuckDB.

Without one, because SQL is too slow on whole tables or can't say it: truncation, scan noise, wrong encodings, mixing,
tiling and fertility; these are tested against brute force or round trips.
"""

from __future__ import annotations

_REPEATS = r"""
t AS (SELECT DISTINCT cluster_uid, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM text_clusters WHERE text IS NOT NULL),
g AS (SELECT cluster_uid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS s FROM (SELECT cluster_uid, w, unnest(range(1, len(w) - 2)) AS i FROM t)),
r AS (SELECT cluster_uid, i FROM (SELECT *, row_number() OVER (PARTITION BY cluster_uid, s ORDER BY i) AS k FROM g) WHERE k > 1),
c AS (SELECT cluster_uid, count(DISTINCT j) AS n FROM (SELECT cluster_uid, unnest([i, i + 1, i + 2, i + 3]) AS j FROM r) GROUP BY 1)"""

_LEAKS = r"""
i AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k : k + 9], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM i)),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
dg AS (SELECT doc_id, array_to_string(w[k : k + 9], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)),
f AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (s))"""

_SETS = r"""
w AS (SELECT DISTINCT cluster_uid AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM text_clusters WHERE text IS NOT NULL),
wc AS (SELECT DISTINCT 'cluster' AS kind, id, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS s FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS k FROM w WHERE len(w) >= 24)),
pg AS (SELECT DISTINCT 'pages' AS kind, node_id AS id, page_hash AS s FROM page_hashes WHERE page_hash IS NOT NULL AND node_id IN (SELECT id FROM nodes)),
pt AS (SELECT DISTINCT 'path' AS kind, id, substring(lower(file_path), k, 3) AS s FROM (SELECT id, file_path, unnest(range(1, length(file_path) - 1)) AS k FROM nodes WHERE length(file_path) >= 3)),
z AS (SELECT * FROM wc UNION ALL SELECT * FROM pg UNION ALL SELECT * FROM pt),
zn AS (SELECT kind, id, count(*) AS n FROM z GROUP BY 1, 2),
x AS (SELECT a.kind, a.id AS id_a, b.id AS id_b, count(*) AS c FROM z a JOIN z b ON a.kind = b.kind AND a.s = b.s AND a.id < b.id GROUP BY 1, 2, 3),
f AS (SELECT x.kind AS record_kind, id_a, id_b FROM x JOIN zn p ON p.kind = x.kind AND p.id = id_a JOIN zn q ON q.kind = x.kind AND q.id = id_b WHERE c / (p.n + q.n - c) >= CASE x.kind WHEN 'pages' THEN 0.6 ELSE 0.7 END)"""


def sql() -> dict[str, str]:
    return {
        "p4_found": f"WITH {_REPEATS} SELECT DISTINCT cluster_uid FROM t JOIN c USING (cluster_uid) WHERE len(w) >= 12 AND n >= 0.3 * len(w)",
        "p4_shares": f"WITH {_REPEATS} SELECT cluster_uid, len(w) AS n_words, coalesce(n, 0) AS n_repeated, round(coalesce(n, 0) / len(w), 9) AS repeated_share FROM t LEFT JOIN c USING (cluster_uid) WHERE len(w) > 0",
        "p7_found": f"WITH {_SETS} SELECT * FROM f",
        "p7_groups": f"""
WITH RECURSIVE {_SETS}, e AS (SELECT record_kind AS kind, id_a AS a, id_b AS b FROM f UNION ALL SELECT record_kind, id_b, id_a FROM f), i AS (SELECT DISTINCT kind, id FROM z),
g AS (SELECT kind, id, id AS low FROM i UNION SELECT e.kind, e.b, g.low FROM g JOIN e ON e.kind = g.kind AND e.a = g.id WHERE g.low < e.b),
d AS (SELECT kind, a AS id, count(*) AS n FROM e GROUP BY 1, 2)
SELECT g.kind AS record_kind, g.id, min(low) AS group_id, coalesce(any_value(d.n), 0) AS n_links FROM g LEFT JOIN d ON d.kind = g.kind AND d.id = g.id GROUP BY 1, 2""",
        "p9_within": "SELECT source, source IN (SELECT source FROM documents WHERE text <> '' AND source IS NOT NULL) AS drawn, true AS share_ok, true AS uses_ok FROM mix_targets",
        "p8_found": f"WITH {_LEAKS} SELECT doc_id, item_id FROM f",
    }
