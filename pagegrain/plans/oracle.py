"""SQL twins of the core queries, for DuckDB. Queries without one here are tested against brute force instead."""

from __future__ import annotations

_WS = r"[\s\x{a0}]"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return rf"regexp_replace(coalesce({x}, ''), '{_WS}+', '', 'g')"


def _words(x: str) -> str:
    return rf"CASE WHEN {_strip(x)} = '' THEN 0 ELSE len(regexp_split_to_array({_strip(x)}, '{_WS}+')) END"


_PAGES = rf"""
d AS (SELECT doc_id, source_format, regexp_split_to_array(text, '(?m)\f|^\s*--- PAGE BREAK ---\s*$') AS arr FROM documents),
e AS (SELECT doc_id, source_format, generate_subscripts(arr, 1) AS i, unnest(arr) AS raw FROM d),
p AS (SELECT doc_id, source_format, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INT) AS page_number, trim(raw, chr(10)) AS page_text FROM e WHERE {_strip("raw")} <> '')"""

_LINES = (
    _PAGES
    + """,
l0 AS (SELECT doc_id, source_format, page_number, string_split(page_text, chr(10)) AS a FROM p),
l1 AS (SELECT doc_id, source_format, page_number, CAST(generate_subscripts(a, 1) - 1 AS INT) AS line_no, unnest(a) AS line FROM l0),
l AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, page_number ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l1)"""
)

_TYPED = (
    _LINES
    + rf""",
t0 AS (SELECT *, {_strip("line")} AS s FROM l),
t1 AS (SELECT *, s <> '' AND coalesce(sum(CAST(s <> '' AS INT)) OVER (PARTITION BY doc_id, page_number ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS first FROM t0),
t2 AS (SELECT *, source_format = 'markdown' AND regexp_matches(s, '^(#{{1,6}})\s+(.*)$') AS md, regexp_matches(s, '^\d+(?:\.\d+)+\s+\S+') AS numbered,
  ({_words("s")}) <= 8 AND regexp_matches(s, '\p{{L}}') AND upper(s) = s AS caps, first AND ({_words("s")}) <= 6 AND NOT regexp_matches(s, '[.!?]$') AS titled,
  regexp_matches(s, '(?i)^(Section|Clause|Article|Definitions?)\b[:\s].*') AS plain FROM t1),
t3 AS (SELECT *, CASE WHEN md THEN length(regexp_extract(s, '^(#{{1,6}})\s+(.*)$', 1)) WHEN plain OR numbered OR caps OR titled THEN
  CASE WHEN titled OR (caps AND first) THEN 1 WHEN numbered THEN greatest(2, length(s) - length(replace(s, '.', '')) + 2) ELSE 2 END END AS level FROM t2 WHERE s <> ''),
t4 AS (SELECT *, CASE WHEN level <= 2 THEN 'SECTION' WHEN level > 2 THEN 'SUBSECTION' WHEN regexp_matches(s, '^(?:\d+[.)]|[-*+])\s+\S+') THEN 'TERM' ELSE 'PARAGRAPH' END AS node_type FROM t3),
t AS (SELECT *, CASE WHEN md THEN CASE WHEN {_strip("regexp_extract(s, '^(#{1,6})\\s+(.*)$', 2)")} <> '' THEN {_strip("regexp_extract(s, '^(#{1,6})\\s+(.*)$', 2)")} ELSE {_strip("regexp_replace(s, '^#+', '')")} END
  WHEN level IS NOT NULL THEN {_strip("regexp_replace(s, ':+$', '')")} WHEN node_type = 'TERM' THEN {_strip(r"regexp_replace(s, '^(?:\d+[.)]|[-*+])\s+', '')")}
  ELSE regexp_replace(substring(s, 1, 80), '{_WS}+$', '') END AS title FROM t4)"""
)

_BLOCKS = (
    _TYPED
    + rf""",
a0 AS (SELECT l.doc_id, l.page_number, l.line_no, l.line, l.start, t.node_type, t.level, t.title, t.s FROM l LEFT JOIN t USING (doc_id, page_number, line_no)),
a1 AS (SELECT *, CASE WHEN node_type = 'PARAGRAPH' AND lag(node_type) OVER (PARTITION BY doc_id, page_number ORDER BY line_no) = 'PARAGRAPH' THEN 0 ELSE 1 END AS isnew FROM a0),
a2 AS (SELECT *, sum(isnew) OVER (PARTITION BY doc_id, page_number ORDER BY line_no) AS run FROM a1),
a3 AS (SELECT *, start + length(regexp_extract(line, '^({_WS}*)', 1)) AS s0, start + length(regexp_extract(line, '^({_WS}*)', 1)) + length(s) - 1 AS e0 FROM a2 WHERE node_type IS NOT NULL),
a4 AS (SELECT doc_id, page_number, run, arg_min(node_type, line_no) AS node_type, min(level) AS level, arg_min(title, line_no) AS title, min(s0) AS start_char, max(e0) AS end_char, count(*) AS n_lines FROM a3 GROUP BY 1, 2, 3),
b AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY run) - 1 AS INT) AS seq FROM a4),
n AS (SELECT b.*, (SELECT max(h.seq) FROM b h WHERE h.doc_id = b.doc_id AND h.page_number = b.page_number AND h.seq < b.seq AND h.level < coalesce(b.level, 9999)) AS parent_seq FROM b)"""
)

_INDEX = (
    _BLOCKS
    + """,
x AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS node_id, CAST(NULL AS VARCHAR) AS parent_id, doc_id, CAST(NULL AS INT) AS page_number, 'DOCUMENT_ROOT' AS node_type, CAST(doc_id AS VARCHAR) AS title, CAST(NULL AS INT) AS start_char, CAST(NULL AS INT) AS end_char FROM p
UNION ALL SELECT doc_id || '|p' || page_number, CAST(doc_id AS VARCHAR), doc_id, page_number, 'PAGE', 'Page ' || page_number, 0, CAST(length(page_text) - 1 AS INT) FROM p
UNION ALL SELECT doc_id || '|p' || page_number || '_b' || seq, coalesce(doc_id || '|p' || page_number || '_b' || parent_seq, doc_id || '|p' || page_number), doc_id, page_number, node_type, title, CAST(start_char AS INT), CAST(end_char AS INT) FROM n)"""
)

_UNITS = """
u AS (SELECT DISTINCT document_id || '|p' || pdf_page_num || '_t' || cluster_number AS source_cluster_id, text FROM text_clusters WHERE document_id IS NOT NULL)"""
_RESOLVED = (
    _UNITS
    + """,
u1 AS (SELECT source_cluster_id, text, length(text) AS n FROM u WHERE text <> ''),
r0 AS (SELECT DISTINCT node_id, ptr_ord, source_cluster_id, start_char, end_char, verbatim_text FROM node_pointers WHERE start_char IS NOT NULL AND end_char IS NOT NULL),
r AS (SELECT node_id, ptr_ord, source_cluster_id, start_char, CASE WHEN end_char = -1 OR end_char >= 100000000 THEN n - 1 ELSE least(end_char, n - 1) END AS end_char, verbatim_text, n FROM r0 JOIN u1 USING (source_cluster_id)
  WHERE start_char <= CASE WHEN end_char = -1 OR end_char >= 100000000 THEN n - 1 ELSE least(end_char, n - 1) END)"""
)


def _islands(src: str, keys: str, s: str, e: str, name: str = "isl") -> str:
    return f"""{name}0 AS (SELECT {keys}, {s} AS s, {e} AS e, max({e}) OVER (PARTITION BY {keys} ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {src} WHERE {s} <= {e}),
{name}1 AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM {name}0),
{name} AS (SELECT {keys}, g, min(s) AS span_start, max(e) AS span_end FROM {name}1 GROUP BY {keys}, g)"""


_TREE = """
n AS (SELECT DISTINCT node_id, parent_id, document_id, node_type, title, level_from_root, coalesce(try_cast(regexp_extract(node_id, '(\\d+)$', 1) AS INT), 0) AS ord FROM semantic_nodes)"""
_PTR = "q AS (SELECT DISTINCT node_id, ptr_ord, source_cluster_id, start_char, end_char, verbatim_text FROM node_pointers)"
_HASH = """
h0 AS (SELECT node_id, page_num, min(page_hash) AS page_hash FROM page_hashes WHERE page_hash IS NOT NULL AND node_id IS NOT NULL GROUP BY 1, 2),
h AS (SELECT node_id, CAST(row_number() OVER (PARTITION BY node_id ORDER BY page_num) - 1 AS INT) AS page_num, page_hash FROM h0),
hl AS (SELECT node_id, count(*) AS n FROM h GROUP BY 1)"""
_CONTAINED = (
    _HASH
    + """,
hf AS (SELECT page_hash, count(*) AS f FROM h GROUP BY 1),
hp AS (SELECT h.node_id, arg_min(h.page_num, (f, h.page_hash, h.page_num)) AS pos FROM h JOIN hf USING (page_hash) GROUP BY 1),
hs AS (SELECT s.node_id AS small_id, b.node_id AS big_id, b.page_num - s.page_num AS start_page, ls.n FROM hp JOIN h s ON s.node_id = hp.node_id AND s.page_num = hp.pos JOIN h b ON b.page_hash = s.page_hash AND b.node_id <> s.node_id
  JOIN hl ls ON ls.node_id = s.node_id JOIN hl lb ON lb.node_id = b.node_id WHERE b.page_num >= s.page_num AND b.page_num - s.page_num + ls.n <= lb.n),
c AS (SELECT hs.small_id, hs.big_id, hs.start_page FROM hs JOIN h s ON s.node_id = hs.small_id JOIN h b ON b.node_id = hs.big_id AND b.page_num = s.page_num + hs.start_page AND b.page_hash = s.page_hash GROUP BY 1, 2, 3, hs.n HAVING count(*) = hs.n)"""
)
_LEDGER = """
f AS (SELECT DISTINCT id, file_path, file_hash FROM nodes),
k AS (SELECT file_path AS file_name, file_hash FROM f JOIN (SELECT file_hash, min(id) AS m FROM f WHERE file_hash IS NOT NULL GROUP BY 1) g USING (file_hash) WHERE f.id <> g.m)"""
_EVENTS = """
ev AS (SELECT min(id) AS id, ts_iso, document_id, run_id, parent_run_id, event_name, model_name, filename, line_number, token_count, cost_usd, n_try, metadata_json FROM ingest_events GROUP BY ALL)"""
_ATTEMPTS = (
    _EVENTS
    + """,
att AS (SELECT id, document_id, line_number AS page_number, coalesce(json_extract_string(metadata_json, '$.stage'), 'none') AS stage, model_name, CASE WHEN event_name = 'llm_end' THEN 'completed' ELSE 'failed' END AS status
  FROM ev WHERE document_id IS NOT NULL AND event_name IN ('llm_end', 'llm_error')),
la AS (SELECT document_id, page_number, stage, count(*) AS attempt_count, max(id) AS mid FROM att GROUP BY 1, 2, 3)"""
)
_TOK = "CAST(greatest(1, (length(coalesce({0}, '')) + 3) // 4) AS BIGINT)"
_OCC = """RECURSIVE
{src},
occ AS (SELECT node_id, ptr_ord, source_cluster_id, start_char, verbatim_text AS v, text, strpos(text, verbatim_text) - 1 AS pos FROM j WHERE strpos(text, verbatim_text) > 0
  UNION ALL SELECT node_id, ptr_ord, source_cluster_id, start_char, v, text, pos + length(v) + strpos(substring(text, CAST(pos + length(v) + 1 AS BIGINT)), v) - 1 FROM occ WHERE strpos(substring(text, CAST(pos + length(v) + 1 AS BIGINT)), v) > 0)"""
_J = _UNITS + """,
j AS (SELECT DISTINCT node_id, ptr_ord, source_cluster_id, {0} AS start_char, verbatim_text, text FROM node_pointers JOIN u USING (source_cluster_id) WHERE verbatim_text <> '' AND text IS NOT NULL {1})"""
_SPANS = _TREE + "," + _PTR + """,
sp AS (SELECT node_id, list(source_cluster_id || ':' || start_char || ':' || end_char) AS spans FROM q WHERE start_char IS NOT NULL AND end_char IS NOT NULL GROUP BY 1),
m AS (SELECT n.*, list_sort(list_distinct(coalesce(sp.spans, []))) AS spans FROM n LEFT JOIN sp USING (node_id))"""


_GROUND = f"""
WITH RECURSIVE {_UNITS}, {_PTR},
g0 AS (SELECT q.*, u.source_cluster_id IS NOT NULL AS known, coalesce(u.text, '') AS text, coalesce(verbatim_text, '') AS v, CASE WHEN end_char >= 100000000 THEN -1 ELSE end_char END AS en FROM q LEFT JOIN u USING (source_cluster_id)),
g1 AS (SELECT *, CASE WHEN en = -1 THEN length(text) ELSE greatest(en + 1, 0) END AS past FROM g0),
g2 AS (SELECT *, CASE WHEN past > greatest(start_char, 0) THEN substring(text, greatest(start_char, 0) + 1, past - greatest(start_char, 0)) ELSE '' END AS actual FROM g1),
g3 AS (SELECT *, {_squeeze("actual")} AS a, {_squeeze("v")} AS w FROM g2),
g4 AS (SELECT *, CASE WHEN NOT known THEN 'unknown' WHEN start_char IS NULL OR end_char IS NULL THEN 'lost' WHEN a = w THEN 'same' WHEN actual <> '' AND (contains(w, a) OR contains(a, w)) THEN 'contain' ELSE 'open' END AS t0 FROM g3),
occ AS (SELECT node_id, ptr_ord, source_cluster_id, start_char, v, text, strpos(text, v) - 1 AS pos FROM g4 WHERE t0 = 'open' AND v <> '' AND strpos(text, v) > 0
  UNION ALL SELECT node_id, ptr_ord, source_cluster_id, start_char, v, text, pos + length(v) + strpos(substring(text, CAST(pos + length(v) + 1 AS BIGINT)), v) - 1 FROM occ WHERE strpos(substring(text, CAST(pos + length(v) + 1 AS BIGINT)), v) > 0),
best AS (SELECT node_id, ptr_ord, source_cluster_id, start_char, v, pos FROM (SELECT *, row_number() OVER (PARTITION BY node_id, ptr_ord, source_cluster_id, start_char, v ORDER BY abs(pos - start_char), pos) AS k FROM occ) WHERE k = 1)"""


_CHAINS = "WITH RECURSIVE f AS (SELECT DISTINCT id, chain_id, prev_id FROM nodes), w AS (SELECT chain_id, id, 0 AS position FROM f WHERE prev_id IS NULL OR NOT EXISTS (SELECT 1 FROM f g WHERE g.id = f.prev_id AND g.chain_id = f.chain_id) UNION ALL SELECT f.chain_id, f.id, w.position + 1 FROM f JOIN w ON f.prev_id = w.id AND f.chain_id = w.chain_id) "


def _chars(x: str) -> str:
    return f"list_sum(list_transform(string_split(coalesce({x}, ''), ''), lambda c: CASE WHEN c = '' THEN 0 ELSE unicode(c) END))"




def sql() -> dict[str, str]:
    title = lambda x: f"lower({_strip(f'regexp_replace({x}, $${_WS}+$$, $$ $$, $$g$$)')})"
    out = {
        "p3_found": """
WITH RECURSIVE l AS (SELECT 'node' AS tree, node_id AS id, min(nullif(parent_id, '')) AS parent FROM semantic_nodes GROUP BY 2
  UNION ALL SELECT 'run', run_id, min(nullif(parent_run_id, '')) FROM ingest_events WHERE run_id IS NOT NULL GROUP BY 2),
good AS (SELECT tree, id FROM l WHERE parent IS NULL OR (tree, parent) NOT IN (SELECT (tree, id) FROM l)
  UNION SELECT l.tree, l.id FROM l JOIN good g ON l.tree = g.tree AND l.parent = g.id),
bad AS (SELECT l.* FROM l ANTI JOIN good g ON l.tree = g.tree AND l.id = g.id),
walk AS (SELECT tree, id, parent AS pos FROM bad UNION SELECT w.tree, w.id, b.parent FROM walk w JOIN bad b ON w.tree = b.tree AND w.pos = b.id),
ring AS (SELECT DISTINCT tree, id FROM walk WHERE id = pos)
SELECT w.tree, w.id AS member_id, min(w.pos) AS loop_id FROM walk w JOIN ring r ON r.tree = w.tree AND r.id = w.pos GROUP BY 1, 2""",
        "p3_hierarchy": """
WITH RECURSIVE l AS (SELECT 'node' AS tree, node_id AS id, min(nullif(parent_id, '')) AS parent FROM semantic_nodes GROUP BY 2
  UNION ALL SELECT 'run', run_id, min(nullif(parent_run_id, '')) FROM ingest_events WHERE run_id IS NOT NULL GROUP BY 2),
g AS (SELECT tree, id, id AS root, 0 AS depth, id AS path FROM l WHERE parent IS NULL OR (tree, parent) NOT IN (SELECT (tree, id) FROM l)
  UNION ALL SELECT l.tree, l.id, g.root, g.depth + 1, g.path || '/' || l.id FROM l JOIN g ON l.tree = g.tree AND l.parent = g.id),
c AS (SELECT a.tree, a.id, count(*) - 1 AS n FROM g a JOIN g b ON a.tree = b.tree AND a.root = b.root AND starts_with(b.path || '/', a.path || '/') GROUP BY 1, 2)
SELECT g.tree, g.id AS member_id, g.root, CAST(g.depth AS BIGINT) AS depth, g.path, c.n AS n_descendants FROM g JOIN c USING (tree, id)""",
        "p3_tours": """
WITH RECURSIVE l AS (SELECT 'node' AS tree, node_id AS id, min(nullif(parent_id, '')) AS parent FROM semantic_nodes GROUP BY 2
  UNION ALL SELECT 'run', run_id, min(nullif(parent_run_id, '')) FROM ingest_events WHERE run_id IS NOT NULL GROUP BY 2),
g AS (SELECT tree, id, id AS root, 0 AS depth, id AS path, [id] AS way FROM l WHERE parent IS NULL OR (tree, parent) NOT IN (SELECT (tree, id) FROM l)
  UNION ALL SELECT l.tree, l.id, g.root, g.depth + 1, g.path || '/' || l.id, list_append(g.way, l.id) FROM l JOIN g ON l.tree = g.tree AND l.parent = g.id),
c AS (SELECT a.tree, a.id, count(*) - 1 AS n FROM g a JOIN g b ON a.tree = b.tree AND a.root = b.root AND starts_with(b.path || '/', a.path || '/') GROUP BY 1, 2),
e AS (SELECT g.tree, g.id, g.root, 2 * (row_number() OVER (PARTITION BY g.tree, g.root ORDER BY way) - 1) - depth AS entry, n FROM g JOIN c USING (tree, id))
SELECT tree, id AS member_id, root, entry, entry + 2 * n + 1 AS exit FROM e""",
        "p3_descendants": """
WITH RECURSIVE l AS (SELECT 'node' AS tree, node_id AS id, min(nullif(parent_id, '')) AS parent FROM semantic_nodes GROUP BY 2
  UNION ALL SELECT 'run', run_id, min(nullif(parent_run_id, '')) FROM ingest_events WHERE run_id IS NOT NULL GROUP BY 2),
g AS (SELECT tree, id, CAST([] AS VARCHAR[]) AS up FROM l WHERE parent IS NULL OR (tree, parent) NOT IN (SELECT (tree, id) FROM l)
  UNION ALL SELECT l.tree, l.id, list_append(g.up, g.id) FROM l JOIN g ON l.tree = g.tree AND l.parent = g.id)
SELECT tree, unnest(up) AS ancestor, id AS descendant FROM g""",
        "p6_found": f"""
WITH {_UNITS},
u1 AS (SELECT source_cluster_id, text, length(text) AS n FROM u WHERE text <> ''),
r AS (SELECT DISTINCT source_cluster_id, greatest(start_char, 0) AS s, CASE WHEN end_char = -1 OR end_char >= 100000000 THEN n - 1 ELSE least(end_char, n - 1) END AS e FROM node_pointers JOIN u1 USING (source_cluster_id) WHERE start_char IS NOT NULL AND end_char IS NOT NULL),
{_islands("r", "source_cluster_id", "s", "e")},
gp AS (SELECT source_cluster_id, span_end + 1 AS span_start, lead(span_start) OVER (PARTITION BY source_cluster_id ORDER BY span_start) - 1 AS span_end FROM isl),
nt AS (SELECT CASE note_kind WHEN 'conflict' THEN 'conflict' ELSE 'missing' END AS span_kind, source_cluster_id, CASE note_kind WHEN 'conflict' THEN overlap_start ELSE gap_start END AS s, CASE note_kind WHEN 'conflict' THEN overlap_end ELSE gap_end END AS e
  FROM layer_notes WHERE note_kind IN ('conflict', 'gap') AND source_cluster_id IS NOT NULL),
{_islands("nt", "span_kind, source_cluster_id", "s", "e", "nti")}
SELECT DISTINCT 'gap' AS span_kind, source_cluster_id, CAST(span_start AS BIGINT) AS span_start, CAST(span_end AS BIGINT) AS span_end FROM gp JOIN u1 USING (source_cluster_id)
  WHERE span_end IS NOT NULL AND regexp_matches(substring(text, CAST(span_start + 1 AS BIGINT), CAST(span_end - span_start + 1 AS BIGINT)), '[^\\s\\x{{a0}}]')
UNION ALL SELECT span_kind, source_cluster_id, CAST(span_start AS BIGINT), CAST(span_end AS BIGINT) FROM nti""",
        "p6_merged": f"""
WITH {_UNITS}, q AS (SELECT DISTINCT source_cluster_id, start_char, end_char FROM node_pointers WHERE start_char IS NOT NULL AND end_char IS NOT NULL AND source_cluster_id IS NOT NULL),
r AS (SELECT source_cluster_id, greatest(start_char, 0) AS s, CASE WHEN end_char = -1 OR end_char >= 100000000 THEN length(text) - 1 ELSE least(end_char, coalesce(length(text) - 1, end_char)) END AS e FROM q LEFT JOIN u USING (source_cluster_id)), {_islands("r", "source_cluster_id", "s", "e")}
SELECT source_cluster_id, CAST(span_start AS BIGINT) AS span_start, CAST(span_end AS BIGINT) AS span_end FROM isl""",
        "p2_pages": """
SELECT DISTINCT page_id, document_id, pdf_page_num, printed_page_number, contains_table, is_empty_page, incomplete_text, scan_quality, metadata.ocr_model_name AS ocr_model_name, metadata.ocr_datetime AS ocr_datetime, metadata.ocr_json_version AS ocr_json_version,
  refined_version IS NOT NULL AS has_refined, coalesce(len(OCR_text_clusters), 0) AS n_texts, coalesce(len(non_text_objects), 0) AS n_objects, coalesce(len(refined_version.OCR_text_clusters), 0) AS n_refined_texts, coalesce(len(refined_version.non_text_objects), 0) AS n_refined_objects FROM split_pages""",
        "units_from_documents": "SELECT doc_id || '|p1_t0' AS unit_id, 'text' AS modality, true AS in_text, length(coalesce(text, '')) AS n_chars FROM documents",
        "units_from_ocr": """
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, OCR_text_clusters, non_text_objects FROM split_pages),
t AS (SELECT document_id, pdf_page_num, unnest(OCR_text_clusters) AS o FROM s), i AS (SELECT document_id, pdf_page_num, unnest(non_text_objects) AS o FROM s)
SELECT document_id || '|p' || pdf_page_num || '_t' || o.cluster_number AS unit_id, 'ocr_text' AS modality, 'default_text' AS embedding_space, true AS in_text, length(coalesce(o.text, '')) AS n_chars FROM t
UNION ALL SELECT document_id || '|p' || pdf_page_num || '_i' || o.cluster_number, 'image_region', 'image', false, length(coalesce(o.description, '')) FROM i""",
        "units_from_pages": f"WITH {_PAGES} SELECT doc_id || '|p' || page_number || '_t0' AS unit_id, length(page_text) AS n_chars FROM p",
        "unit_id_collisions": "SELECT document_id || '|p' || pdf_page_num || '_t' || cluster_number AS unit_id, count(*) AS n FROM text_clusters GROUP BY 1 HAVING count(*) > 1",
        "unit_validity": """
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, OCR_text_clusters, non_text_objects FROM split_pages), t AS (SELECT unnest(OCR_text_clusters) AS o FROM s), i AS (SELECT unnest(non_text_objects) AS o FROM s)
SELECT 'ocr_text' AS modality, coalesce(o.text, '') <> '' AS valid, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'image_region', coalesce(o.description, '') <> '', count(*) FROM i GROUP BY 2""",
        "page_validity": """
WITH s AS (SELECT DISTINCT page_id, OCR_text_clusters, non_text_objects, meaningful_ordering, is_empty_page FROM split_pages),
v AS (SELECT page_id, is_empty_page, list_transform(coalesce(OCR_text_clusters, []), lambda x: x.cluster_number) AS t, list_transform(coalesce(non_text_objects, []), lambda x: x.cluster_number) AS o, coalesce(meaningful_ordering, []) AS m FROM s)
SELECT page_id, coalesce(is_empty_page, false) = (len(t) + len(o) = 0) AS empty_ok, NOT list_has_any(t, o) AND len(list_distinct(t)) = len(t) AND len(list_distinct(o)) = len(o) AS ids_ok, len(list_distinct(m)) = len(m) AS order_ok FROM v""",
        "page_text_in_order": """
WITH s AS (SELECT DISTINCT page_id, OCR_text_clusters, meaningful_ordering FROM split_pages), t AS (SELECT page_id, meaningful_ordering AS m, unnest(OCR_text_clusters) AS o FROM s),
v AS (SELECT page_id, coalesce(list_position(m, o.cluster_number), 0) AS pos, o.cluster_number AS c, coalesce(o.text, '') AS t FROM t)
SELECT page_id, string_agg(t, chr(10) ORDER BY pos = 0, pos, c, t) AS text FROM v GROUP BY 1""",
        "mode_projection": "SELECT doc_id || '|p1_t0' AS unit_id, 1 AS page_number, 'text' AS modality, coalesce(text, '') AS parser_text FROM documents",
        "embedding_space_counts": "SELECT label, count(*) AS n, min(len(embedding)) AS dims FROM embeddings GROUP BY 1",
        "document_pages": f"WITH {_PAGES} SELECT doc_id, page_number, length(page_text) AS n_chars FROM p",
        "line_offsets": f"WITH {_LINES} SELECT doc_id, page_number, line_no, start, length(line) AS n_chars FROM l",
        "block_types": f"WITH {_TYPED} SELECT doc_id, page_number, line_no, node_type, level, title FROM t",
        "paragraph_groups": f"WITH {_BLOCKS} SELECT doc_id, page_number, seq, node_type, CAST(start_char AS BIGINT) AS start_char, CAST(end_char AS BIGINT) AS end_char, n_lines FROM b",
        "heading_parents": f"WITH {_BLOCKS} SELECT doc_id, page_number, seq, level, parent_seq FROM n",
        "page_index_nodes": f"WITH {_INDEX} SELECT node_id, parent_id, node_type, title, start_char, end_char FROM x",
        "page_index_summary": f"""
WITH {_INDEX}, k AS (SELECT doc_id, page_number, count(*) FILTER (WHERE NOT contains(parent_id, '_b')) AS k FROM x WHERE node_type NOT IN ('PAGE', 'DOCUMENT_ROOT') GROUP BY 1, 2), k2 AS (SELECT doc_id, max(k) AS m FROM k GROUP BY 1)
SELECT doc_id, count(*) FILTER (WHERE node_type = 'PAGE') AS n_pages, count(*) AS n_nodes, count(DISTINCT node_type) AS n_types, coalesce(any_value(m), 0) AS max_page_children FROM x LEFT JOIN k2 USING (doc_id) GROUP BY 1""",
        "fallback_tree": f"""
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, OCR_text_clusters FROM split_pages), t AS (SELECT document_id, pdf_page_num, unnest(OCR_text_clusters) AS o FROM s)
SELECT document_id || '|p' || pdf_page_num || '_t' || o.cluster_number AS node_id, document_id || '|p' || pdf_page_num AS parent_id, 'TEXT_FLOW' AS node_type, substring(string_split({_strip("coalesce(o.text, '')")}, chr(10))[1], 1, 80) AS title, 2 AS level_from_root FROM t
UNION ALL SELECT DISTINCT document_id || '|p' || pdf_page_num, document_id, 'PAGE', 'Page ' || pdf_page_num, 1 FROM t UNION ALL SELECT DISTINCT document_id, NULL, 'DOCUMENT_ROOT', document_id, 0 FROM t""",
        "source_summary": f"""
WITH {_BLOCKS}, pb AS (SELECT doc_id, count(*) FILTER (WHERE node_type = 'SECTION') AS n_section, count(*) FILTER (WHERE node_type = 'SUBSECTION') AS n_subsection, count(*) FILTER (WHERE node_type = 'PARAGRAPH') AS n_paragraph, count(*) FILTER (WHERE node_type = 'TERM') AS n_term, sum(end_char - start_char + 1) AS covered FROM b GROUP BY 1),
pp AS (SELECT doc_id, count(*) AS n_pages, sum(length(page_text)) AS total FROM p GROUP BY 1)
SELECT source, count(*) AS n_documents, CAST(coalesce(sum(n_pages), 0) AS BIGINT) AS n_pages, CAST(coalesce(sum(n_section), 0) AS BIGINT) AS n_section, CAST(coalesce(sum(n_subsection), 0) AS BIGINT) AS n_subsection, CAST(coalesce(sum(n_paragraph), 0) AS BIGINT) AS n_paragraph, CAST(coalesce(sum(n_term), 0) AS BIGINT) AS n_term, round(sum(covered) / sum(total), 9) AS coverage
FROM documents LEFT JOIN pp USING (doc_id) LEFT JOIN pb USING (doc_id) GROUP BY 1""",
        "interval_islands": f"WITH {_RESOLVED}, {_islands('r', 'source_cluster_id', 'start_char', 'end_char')} SELECT source_cluster_id, span_start, span_end FROM isl",
        "span_coverage": f"WITH {_RESOLVED}, {_islands('r', 'source_cluster_id, n', 'start_char', 'end_char')} SELECT source_cluster_id, CAST(sum(span_end - span_start + 1) AS BIGINT) AS covered, n AS total FROM isl GROUP BY 1, n",
        "overall_coverage": f"WITH {_RESOLVED}, {_islands('r', 'source_cluster_id, n', 'start_char', 'end_char')}, g AS (SELECT source_cluster_id, sum(span_end - span_start + 1) AS c, n FROM isl GROUP BY 1, n) SELECT round(coalesce(sum(c) / sum(n), 1), 9) AS coverage FROM g",
        "exact_occurrences": "WITH " + _OCC.format(src=_J.format("0", "")) + " SELECT node_id, ptr_ord, source_cluster_id, CAST(pos AS INT) AS start_at FROM occ",
        "nearest_occurrence": "WITH " + _OCC.format(src=_J.format("start_char", "AND start_char IS NOT NULL")) + ", z AS (SELECT *, row_number() OVER (PARTITION BY node_id, ptr_ord, source_cluster_id, start_char, v ORDER BY abs(pos - start_char), pos) AS k FROM occ) SELECT node_id, ptr_ord, source_cluster_id, start_char, CAST(pos AS INT) AS start_at FROM z WHERE k = 1",
        "sibling_overlaps": f"""
WITH {_RESOLVED}, {_TREE}, cp AS (SELECT parent_id, r.node_id AS child_id, CAST(ord AS BIGINT) * 1000 + ptr_ord AS ord, source_cluster_id, start_char, end_char, lower({_squeeze("verbatim_text")}) AS said FROM n JOIN r USING (node_id) WHERE parent_id <> '')
SELECT DISTINCT a.parent_id, a.source_cluster_id, a.child_id AS left_child, b.child_id AS right_child, CAST(greatest(a.start_char, b.start_char) AS INT) AS overlap_start, CAST(least(a.end_char, b.end_char) AS INT) AS overlap_end, CASE WHEN a.start_char = b.start_char AND a.end_char = b.end_char AND a.said = b.said THEN 'duplicate' ELSE 'overlap' END AS conflict_kind
FROM cp a JOIN cp b ON a.parent_id = b.parent_id AND a.source_cluster_id = b.source_cluster_id AND a.ord < b.ord AND greatest(a.start_char, b.start_char) <= least(a.end_char, b.end_char) WHERE a.child_id <> b.child_id""",
        "duplicate_children": f"""
WITH {_TREE}, {_PTR}, fp AS (SELECT node_id, string_agg(concat_ws(':', source_cluster_id, start_char, end_char, lower({_squeeze("verbatim_text")})), '|' ORDER BY ptr_ord, concat_ws(':', source_cluster_id, start_char, end_char, lower({_squeeze("verbatim_text")}))) AS f FROM q GROUP BY 1),
z AS (SELECT parent_id, node_id AS child_id, first_value(node_id) OVER (PARTITION BY parent_id, lower({_strip("title")}), coalesce(f, '') ORDER BY ord, node_id) AS duplicate_of FROM n LEFT JOIN fp USING (node_id) WHERE parent_id <> '')
SELECT * FROM z WHERE child_id <> duplicate_of""",
        "coverage_gaps": f"""
WITH {_RESOLVED}, {_TREE}, ch AS (SELECT parent_id, source_cluster_id, start_char, end_char FROM n JOIN r USING (node_id) WHERE parent_id <> ''),
pr AS (SELECT DISTINCT node_id AS parent_id, source_cluster_id, start_char AS ps, end_char AS pe FROM r WHERE node_id IN (SELECT parent_id FROM ch)),
cc AS (SELECT parent_id, source_cluster_id, ps, pe, greatest(start_char, ps) AS s, least(end_char, pe) AS e FROM pr JOIN ch USING (parent_id, source_cluster_id) WHERE start_char <= pe AND end_char >= ps UNION ALL SELECT *, ps - 1, ps - 1 FROM pr UNION ALL SELECT *, pe + 1, pe + 1 FROM pr),
{_islands("cc", "parent_id, source_cluster_id, ps, pe", "s", "e")}, gp AS (SELECT parent_id, source_cluster_id, span_end + 1 AS s, lead(span_start) OVER (PARTITION BY parent_id, source_cluster_id, ps, pe ORDER BY span_start) - 1 AS e FROM isl)
SELECT DISTINCT parent_id, source_cluster_id, CAST(s AS BIGINT) AS gap_start, CAST(e AS BIGINT) AS gap_end FROM gp JOIN u1 USING (source_cluster_id) WHERE e IS NOT NULL AND regexp_matches(substring(text, CAST(s + 1 AS BIGINT), CAST(e - s + 1 AS BIGINT)), '[^\\s\\x{{a0}}]')""",
        "overlap_tolerance": f"WITH {_RESOLVED}, z AS (SELECT DISTINCT source_cluster_id, start_char, end_char FROM r), y AS (SELECT *, max(end_char) OVER (PARTITION BY source_cluster_id ORDER BY start_char, end_char ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_end FROM z) SELECT * FROM y WHERE prior_end - start_char + 1 > 8",
        "level_dedupe": f"WITH {_SPANS}, z AS (SELECT *, row_number() OVER (PARTITION BY node_type, {title('title')}, document_id, spans ORDER BY ord, node_id) AS k FROM m) SELECT node_id, node_type FROM z WHERE k = 1",
        "layer_dedupe": f"""
WITH {_TREE}, z AS (SELECT c.node_id, c.parent_id, row_number() OVER (PARTITION BY c.parent_id, c.node_type, lower({_strip("coalesce(c.title, '')")}) ORDER BY c.ord, c.node_id) AS k FROM n c JOIN n p ON c.parent_id = p.node_id WHERE c.parent_id <> '' AND lower({_strip("coalesce(c.title, '')")}) <> lower({_strip("coalesce(p.title, '')")}))
SELECT node_id, parent_id FROM z WHERE k = 1""",
        "mirror_guard": f"WITH {_SPANS}, pl AS (SELECT DISTINCT node_type, {title('title')} AS t, spans FROM m WHERE parent_id IS NULL OR parent_id = '' OR node_type = 'SECTION') SELECT node_id FROM m WHERE node_type NOT IN ('PAGE', 'DOCUMENT_ROOT') AND NOT EXISTS (SELECT 1 FROM pl WHERE pl.node_type = m.node_type AND pl.t IS NOT DISTINCT FROM {title('m.title')} AND pl.spans = m.spans)",
        "type_guard": f"WITH {_TREE} SELECT c.node_id, CASE WHEN c.node_type = 'KEY_VALUE_PAIR' AND p.node_type = 'KEY_VALUE_PAIR' THEN 'TEXT_FLOW' ELSE c.node_type END AS node_type FROM n c JOIN n p ON c.parent_id = p.node_id WHERE c.parent_id <> ''",
        "cud_apply": f"WITH {_TREE} SELECT node_id, node_type, CASE WHEN node_type = 'SECTION' THEN '[edited] ' || coalesce(title, '') ELSE title END AS title FROM n WHERE node_type <> 'TERM' UNION ALL SELECT DISTINCT document_id || '|summary', 'TEXT_FLOW', 'Summary' FROM n WHERE document_id IS NOT NULL",
        "frontier_bfs": f"""
WITH RECURSIVE {_TREE}, w AS (SELECT node_id, 0 AS depth, [lpad(CAST(ord AS VARCHAR), 12, '0') || node_id] AS way FROM n WHERE parent_id IS NULL OR parent_id = '' UNION ALL SELECT n.node_id, w.depth + 1, list_append(w.way, lpad(CAST(n.ord AS VARCHAR), 12, '0') || n.node_id) FROM n JOIN w ON n.parent_id = w.node_id)
SELECT node_id, depth, row_number() OVER (PARTITION BY depth ORDER BY way) - 1 AS wave_order FROM w""",
        "graph_nodes": f"""
WITH {_TREE}, {_PTR}, sp AS (SELECT node_id, count(*) AS k, arg_min(greatest(end_char + 1, start_char + greatest(length(coalesce(verbatim_text, '')), 1)), (ptr_ord, source_cluster_id, start_char)) AS f FROM q WHERE start_char IS NOT NULL AND end_char IS NOT NULL GROUP BY 1)
SELECT node_id AS id, title AS label, node_type AS semantic_node_type, document_id AS doc_id, coalesce(k, 1) AS n_spans, coalesce(f, 1) AS first_end FROM n LEFT JOIN sp USING (node_id)""",
        "graph_edges": f"WITH {_TREE} SELECT sha256('edge' || chr(31) || coalesce(nullif(parent_id, ''), 'root') || chr(31) || coalesce(nullif(node_id, ''), 'root')) AS id, 'HAS_CHILD' AS relation, parent_id AS source_id, node_id AS target_id, document_id AS doc_id FROM (SELECT DISTINCT node_id, parent_id, document_id FROM n) WHERE parent_id IN (SELECT node_id FROM n)",
        "init_session": f"WITH {_UNITS} SELECT regexp_extract(source_cluster_id, '^(.*)\\|p\\d+_t\\d+$', 1) || '|root' AS node_id, CAST(row_number() OVER (PARTITION BY regexp_extract(source_cluster_id, '^(.*)\\|p\\d+_t\\d+$', 1) ORDER BY source_cluster_id) - 1 AS INT) AS ptr_ord, source_cluster_id, -1 AS end_char, length(coalesce(text, '')) AS n_chars FROM u",
        "page_units_order": """
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, OCR_text_clusters, non_text_objects FROM split_pages), t AS (SELECT document_id AS d, pdf_page_num AS p, unnest(OCR_text_clusters) AS o FROM s), i AS (SELECT document_id AS d, pdf_page_num AS p, unnest(non_text_objects) AS o FROM s),
u AS (SELECT d, p, o.cluster_number AS c, d || '|p' || p || '_t' || o.cluster_number AS unit_id FROM t UNION ALL SELECT d, p, o.cluster_number, d || '|p' || p || '_i' || o.cluster_number FROM i)
SELECT unit_id, row_number() OVER (PARTITION BY d ORDER BY p, c, unit_id) - 1 AS place FROM u""",
        "parser_inputs": """
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, printed_page_number, coalesce(contains_table, false) AS contains_table, coalesce(OCR_text_clusters, []) AS t, coalesce(non_text_objects, []) AS o FROM split_pages),
z AS (SELECT DISTINCT document_id, pdf_page_num, printed_page_number, contains_table, list_transform(t, lambda x: coalesce(x.text, '')) AS tt, list_transform(t, lambda x, i: coalesce(x.cluster_number, i - 1)) AS tn,
  list_transform(o, lambda x: coalesce(nullif(x.description, ''), 'image-region')) AS oo, list_transform(o, lambda x, i: coalesce(x.cluster_number, i - 1 + len(t))) AS oc FROM s)
SELECT document_id, pdf_page_num, contains_table, md5(array_to_string(tt, '|')) AS texts, array_to_string(tn, '|') AS text_numbers, array_to_string(oo, '|') AS objects, array_to_string(oc, '|') AS object_numbers FROM z""",
        "primary_collection": "SELECT min(collection_id) AS collection_id FROM documents",
        "embedding_spaces": "SELECT document_id AS collection_id, CASE WHEN bool_or(coalesce(len(non_text_objects), 0) > 0) THEN 'default_text,image' ELSE 'default_text' END AS spaces FROM split_pages WHERE coalesce(len(OCR_text_clusters), 0) + coalesce(len(non_text_objects), 0) > 0 GROUP BY 1",
        "refine_wanted": "SELECT DISTINCT page_id, refined_version IS NULL AND coalesce(contains_table, false) AND coalesce(len(OCR_text_clusters), 0) >= 5 AS wanted FROM split_pages",
        "prepare_frontier": f"""
WITH {_TREE}, {_PTR}, c AS (SELECT node_id, count(*) AS k FROM q GROUP BY 1), z AS (SELECT document_id AS collection_id, node_id AS parent_node_id, level_from_root AS depth, CAST(ord AS BIGINT) AS "order", title, min(level_from_root) OVER (PARTITION BY document_id) AS low FROM n WHERE document_id IS NOT NULL AND level_from_root IS NOT NULL)
SELECT collection_id, parent_node_id, depth, "order", coalesce(title, parent_node_id) AS title, coalesce(k, 0) AS n_pointers, 0 AS retry_count FROM z LEFT JOIN c ON c.node_id = parent_node_id WHERE depth = low""",
        "enqueue_next": f"""
WITH {_TREE}, z AS (SELECT document_id AS c, node_id AS p, level_from_root AS depth, CAST(ord AS BIGINT) AS o, min(level_from_root) OVER (PARTITION BY document_id) AS low FROM n WHERE document_id IS NOT NULL AND level_from_root IS NOT NULL),
r AS (SELECT c AS collection_id, p AS parent_node_id, depth, o AS "order" FROM z WHERE depth > low), m AS (SELECT collection_id, max("order") + 1 AS last FROM r GROUP BY 1),
k AS (SELECT z.c, n.node_id, z.depth + 1 AS depth, row_number() OVER (PARTITION BY z.c ORDER BY z.o, n.ord, n.node_id) - 1 AS i FROM z JOIN n ON n.parent_id = z.p WHERE z.depth = low AND z.depth + 1 < 3 AND n.node_type <> 'KEY_VALUE_PAIR')
SELECT * FROM r UNION ALL SELECT c, node_id, k.depth, i + coalesce(last, 0) FROM k LEFT JOIN m ON m.collection_id = k.c""",
        "commit_layer": f"""
WITH {_TREE}, z AS (SELECT DISTINCT node_id, nullif(parent_id, '') AS parent_id, node_type, level_from_root FROM n), t AS (SELECT * FROM z WHERE node_type IN ('PAGE', 'DOCUMENT_ROOT'))
SELECT node_id, level_from_root FROM t UNION ALL SELECT c.node_id, u.l + 1 FROM z c JOIN (SELECT node_id, any_value(level_from_root) AS l FROM t GROUP BY 1) u ON u.node_id = c.parent_id WHERE c.node_type NOT IN ('PAGE', 'DOCUMENT_ROOT') AND c.node_id NOT IN (SELECT node_id FROM t)""",
        "prompt_view": f"""
WITH {_TREE}, {_PTR}, v AS (SELECT node_id, list(left(coalesce(verbatim_text, ''), 120) || CASE WHEN length(coalesce(verbatim_text, '')) > 120 THEN '…' ELSE '' END ORDER BY ptr_ord, source_cluster_id, start_char NULLS FIRST, end_char NULLS FIRST)[1:2] AS l FROM q GROUP BY 1)
SELECT parent_id, row_number() OVER (PARTITION BY parent_id ORDER BY ord, n.node_id) - 1 AS local_id, n.node_id, coalesce(len(l), 0) AS n_shown, md5(array_to_string(l, '|')) AS shown FROM n LEFT JOIN v USING (node_id) WHERE parent_id <> ''""",
        "unmatched_ids": "SELECT node_id, 'extra' AS side FROM (SELECT DISTINCT node_id FROM node_pointers WHERE node_id IS NOT NULL AND node_id NOT IN (SELECT node_id FROM semantic_nodes WHERE node_id IS NOT NULL)) UNION ALL SELECT node_id, 'missing' FROM (SELECT DISTINCT node_id FROM semantic_nodes WHERE node_id IS NOT NULL AND node_id NOT IN (SELECT node_id FROM node_pointers WHERE node_id IS NOT NULL))",
        "cud_loop": f"""
WITH {_TREE}, l AS (SELECT document_id AS c, node_id, node_type, title, row_number() OVER (PARTITION BY document_id ORDER BY ord, node_id) AS i FROM n WHERE document_id IS NOT NULL AND parent_id <> ''),
f AS (SELECT c, min(i) AS i FROM l WHERE node_type = 'SECTION' AND title IS NOT NULL GROUP BY c, {title('title')}), z AS (SELECT l.c, l.node_type, CASE WHEN f.i IS NOT NULL THEN 1 ELSE 0 END AS e FROM l LEFT JOIN f ON f.c = l.c AND f.i = l.i WHERE l.node_type <> 'TERM' UNION ALL SELECT DISTINCT c, 'TEXT_FLOW', 0 FROM l WHERE node_type <> 'TERM')
SELECT c AS collection_id, node_type, count(*) AS n, sum(e) AS n_edited FROM z GROUP BY 1, 2""",
        "edge_spans": f"""
WITH {_TREE}, {_PTR}, sp AS (SELECT node_id, count(*) AS k FROM q WHERE start_char IS NOT NULL AND end_char IS NOT NULL AND source_cluster_id IS NOT NULL GROUP BY 1)
SELECT sha256('edge' || chr(31) || coalesce(nullif(e.parent_id, ''), 'root') || chr(31) || coalesce(nullif(e.node_id, ''), 'root')) AS id, coalesce(a.k, b.k, 0) AS n_spans FROM (SELECT DISTINCT node_id, parent_id, document_id FROM n) e LEFT JOIN sp a ON a.node_id = e.node_id LEFT JOIN sp b ON b.node_id = e.parent_id WHERE parent_id IN (SELECT node_id FROM n)""",
        "legacy_graph_nodes": f"""
WITH {_TREE}, {_PTR}, sp AS (SELECT node_id, count(*) AS k, left(string_agg(coalesce(verbatim_text, ''), chr(10) ORDER BY ptr_ord, source_cluster_id, start_char NULLS FIRST, end_char NULLS FIRST), 4000) AS t, list(source_cluster_id ORDER BY ptr_ord, source_cluster_id, start_char NULLS FIRST)[1] AS u FROM q GROUP BY 1)
SELECT node_id AS id, CASE WHEN parent_id IS NULL OR parent_id = '' THEN 'document_root' END AS kind, md5(title || ':' || chr(10) || coalesce(t, '')) AS summary, coalesce(k, 0) AS n_spans, CAST(nullif(regexp_extract(u, '(?:^|\\|)p(\\d+)_', 1), '') AS INT) AS first_page FROM n LEFT JOIN sp USING (node_id)""",
        "legacy_graph_edges": f"""
WITH {_TREE}, {_PTR}, sp AS (SELECT node_id, count(*) AS k FROM q GROUP BY 1)
SELECT sha256('legacy-edge' || chr(31) || 'HAS_CHILD' || chr(31) || parent_id || chr(31) || e.node_id || chr(31) || coalesce(nullif(document_id, ''), 'root') || chr(31) || 'semantic_document_parser_v1') AS id, parent_id || ' -> ' || e.node_id || ' (HAS_CHILD)' AS summary, coalesce(k, 0) AS n_spans FROM (SELECT DISTINCT node_id, parent_id, document_id FROM n) e LEFT JOIN sp ON sp.node_id = e.parent_id WHERE parent_id IN (SELECT node_id FROM n)""",
        "children_in_order": f"WITH {_TREE} SELECT parent_id, string_agg(node_id, ',' ORDER BY ord, node_id) AS children FROM n WHERE parent_id <> '' GROUP BY 1",
        "graph_roundtrip": f"WITH {_TREE} SELECT node_id, CASE WHEN parent_id IN (SELECT node_id FROM n) THEN parent_id END AS parent_id, node_type, title, level_from_root FROM n",
        "temp_ids": "SELECT node_id AS id, 'nn:' || row_number() OVER (ORDER BY node_id) AS temp_id FROM (SELECT DISTINCT node_id FROM semantic_nodes)",
        "temp_edges": f"""
WITH {_TREE}, ti AS (SELECT node_id AS id, 'nn:' || row_number() OVER (ORDER BY node_id) AS t FROM (SELECT DISTINCT node_id FROM n))
SELECT sha256('edge' || chr(31) || coalesce(nullif(parent_id, ''), 'root') || chr(31) || coalesce(nullif(node_id, ''), 'root')) AS id, a.t AS source_id, b.t AS target_id FROM (SELECT DISTINCT node_id, parent_id FROM n) e JOIN ti a ON a.id = e.parent_id JOIN ti b ON b.id = e.node_id""",
        "insert_if_absent": f"WITH {_TREE} SELECT node_id AS id, node_type FROM n WHERE node_type NOT IN ('PAGE', 'DOCUMENT_ROOT')",
        "digest_waves": """
WITH RECURSIVE l AS (SELECT DISTINCT node_id AS id, nullif(parent_id, '') AS parent FROM semantic_nodes), e AS (SELECT id, parent FROM l WHERE parent IN (SELECT id FROM l)),
stuck AS (SELECT id FROM l), up AS (SELECT id, parent FROM e), w AS (SELECT id, 0 AS k FROM l WHERE id NOT IN (SELECT parent FROM e) UNION SELECT e.parent, w.k + 1 FROM w JOIN e ON e.id = w.id WHERE w.k < 60),
good AS (SELECT id FROM l WHERE parent IS NULL OR parent NOT IN (SELECT id FROM l) UNION SELECT l.id FROM l JOIN good ON l.parent = good.id),
r AS (SELECT e.id AS id, e.parent AS pos FROM e WHERE e.id NOT IN (SELECT id FROM good) UNION SELECT r.id, e.parent FROM r JOIN e ON r.pos = e.id), loopy AS (SELECT DISTINCT id FROM r WHERE id = pos)
SELECT id AS node_id, max(k) AS wave FROM w WHERE id NOT IN (SELECT id FROM loopy) GROUP BY 1""",
        "digest_payload": f"""
WITH {_TREE}, {_PTR}, own AS (SELECT node_id, string_agg(verbatim_text, '' ORDER BY ptr_ord, verbatim_text) AS t FROM q WHERE verbatim_text IS NOT NULL GROUP BY 1),
kd AS (SELECT parent_id AS node_id, sum({_TOK.format("substring(coalesce(title, ''), 1, 120)")}) AS k FROM n WHERE parent_id <> '' GROUP BY 1), z AS (SELECT node_id, {_TOK.format("t")} AS mine, CAST(k AS BIGINT) AS k FROM n LEFT JOIN own USING (node_id) LEFT JOIN kd USING (node_id))
SELECT node_id, CASE WHEN k < mine THEN 'children' ELSE 'verbatim' END AS payload_kind, CASE WHEN k < mine THEN k ELSE mine END AS tokens FROM z""",
        "export_bundle": f"WITH {_TREE}, ed AS (SELECT document_id, count(*) AS k FROM (SELECT DISTINCT node_id, parent_id, document_id FROM n) WHERE parent_id IN (SELECT node_id FROM n) GROUP BY 1) SELECT n.document_id AS doc_id, count(*) AS n_nodes, coalesce(any_value(k), 0) AS n_edges, count(DISTINCT node_type) AS n_types, max(level_from_root) AS max_level, 'canonical' AS mode FROM n LEFT JOIN ed ON n.document_id = ed.document_id GROUP BY 1",
        "hash_sequences": f"WITH {_HASH} SELECT node_id, page_num, page_hash FROM h",
        "containing_documents": f"WITH {_CONTAINED} SELECT small_id, big_id, CAST(start_page AS INT) AS start_page FROM c",
        "contained_documents": f"WITH {_CONTAINED} SELECT DISTINCT small_id, big_id FROM c",
        "containment_duplicates": f"WITH {_CONTAINED} SELECT DISTINCT small_id, big_id FROM c JOIN hl a ON a.node_id = small_id JOIN hl b ON b.node_id = big_id WHERE a.n < b.n OR small_id > big_id",
        "page_count_filters": f"WITH {_HASH} SELECT node_id, count(*) AS n_pages, max(page_num) AS last_page FROM h GROUP BY 1 HAVING count(*) >= 10",
        "chain_order": "WITH RECURSIVE f AS (SELECT DISTINCT id, chain_id, prev_id FROM nodes), w AS (SELECT chain_id, id, 0 AS position FROM f WHERE prev_id IS NULL OR NOT EXISTS (SELECT 1 FROM f g WHERE g.id = f.prev_id AND g.chain_id = f.chain_id) UNION ALL SELECT f.chain_id, f.id, w.position + 1 FROM f JOIN w ON f.prev_id = w.id AND f.chain_id = w.chain_id) SELECT chain_id, id, CAST(position AS BIGINT) AS position FROM w",
        "chain_relink": """
WITH RECURSIVE f AS (SELECT DISTINCT id, chain_id, prev_id, file_hash FROM nodes), w AS (SELECT chain_id, id, 0 AS position FROM f WHERE prev_id IS NULL OR NOT EXISTS (SELECT 1 FROM f g WHERE g.id = f.prev_id AND g.chain_id = f.chain_id) UNION ALL SELECT f.chain_id, f.id, w.position + 1 FROM f JOIN w ON f.prev_id = w.id AND f.chain_id = w.chain_id)
SELECT chain_id, id, row_number() OVER c - 1 AS position, lag(id) OVER c AS prev_id, lead(id) OVER c AS next_id FROM w WHERE id NOT IN (SELECT id FROM f WHERE file_hash IS NULL) WINDOW c AS (PARTITION BY chain_id ORDER BY position, id)""",
        "exact_duplicates": "WITH f AS (SELECT DISTINCT id, file_hash FROM nodes WHERE file_hash IS NOT NULL), g AS (SELECT file_hash, min(id) AS m FROM f GROUP BY 1) SELECT file_hash, id, m AS duplicate_of FROM f JOIN g USING (file_hash) WHERE id <> m",
        "duplicate_texts": "WITH g AS (SELECT text, min(doc_id) AS m FROM documents WHERE text IS NOT NULL GROUP BY 1) SELECT doc_id, m AS first_id FROM documents JOIN g USING (text) WHERE doc_id <> m",
        "canonical_files": f"WITH {_LEDGER} SELECT DISTINCT id, file_path FROM f WHERE file_path NOT IN (SELECT file_name FROM k WHERE file_name IS NOT NULL)",
        "non_duplicate_hash": f"""
WITH {_LEDGER}, d AS (SELECT DISTINCT id, file_hash FROM f)
SELECT 'as it is' AS ledger, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM d WHERE file_hash NOT IN (SELECT file_hash FROM k)
UNION ALL SELECT 'with a null', count(*), CAST(sum(id) AS BIGINT) FROM d WHERE file_hash NOT IN (SELECT file_hash FROM k UNION ALL SELECT NULL)
UNION ALL SELECT 'empty', count(*), CAST(sum(id) AS BIGINT) FROM d WHERE file_hash NOT IN (SELECT file_hash FROM k WHERE false)""",
        "canonical_page_stats": f"WITH {_LEDGER}, {_HASH}, v AS (SELECT DISTINCT id, chain_id, file_path FROM nodes WHERE file_path NOT IN (SELECT file_name FROM k WHERE file_name IS NOT NULL)) SELECT chain_id, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_pages, max(n) AS most_pages FROM v JOIN hl ON hl.node_id = v.id GROUP BY 1",
        "missing_in_chain": "SELECT DISTINCT file_path FROM nodes WHERE file_path NOT IN (SELECT file_path FROM nodes WHERE file_hash IS NOT NULL)",
        "chain_list": _CHAINS + "SELECT chain_id, count(*) AS n_nodes, arg_min(id, (position, id)) AS head_id, arg_max(id, (position, id)) AS tail_id FROM w GROUP BY 1",
        "chain_apply": _CHAINS.rstrip() + """,
z AS (SELECT w.chain_id, file_path, position FROM w JOIN (SELECT DISTINCT id, file_path FROM nodes) USING (id)), hd AS (SELECT chain_id AS c, min(file_path) AS p FROM z WHERE position = 0 GROUP BY 1),
rf AS (SELECT hd.c, arg_min(z.chain_id, (z.chain_id, z.position)) AS chain_id, arg_min(z.position, (z.chain_id, z.position)) AS position FROM hd JOIN z ON z.file_path = hd.p GROUP BY 1),
y AS (SELECT chain_id, file_path, position AS a, 0 AS b, 0 AS d FROM z UNION ALL SELECT chain_id, 'behind/' || c, position, c * 2, 1 FROM rf UNION ALL SELECT chain_id, 'before/' || c, position, c * 2, 0.5 FROM rf)
SELECT chain_id, file_path, row_number() OVER (PARTITION BY chain_id ORDER BY a, d > 0, b, d, file_path) - 1 AS position FROM y UNION ALL SELECT (SELECT max(chain_id) + 1 FROM z), 'own/0', 0""",
        "backfill_needs": """
WITH h AS (SELECT DISTINCT node_id, page_num, page_hash FROM page_hashes WHERE page_num > 0), m AS (SELECT DISTINCT id AS node_id FROM nodes WHERE lower(file_path) LIKE '%.pdf' AND id NOT IN (SELECT node_id FROM h WHERE node_id IS NOT NULL)),
a AS (SELECT node_id, page_num FROM h WHERE node_id NOT IN (SELECT node_id FROM m) OR node_id IS NULL UNION ALL SELECT node_id, 0 FROM m) SELECT node_id, count(*) AS n_rows, min(page_num) AS first_page FROM a GROUP BY 1""",
        "duplicate_names": "SELECT name, count(*) AS n FROM (SELECT DISTINCT id, file_path, split_part(file_path, '/', -1) AS name FROM nodes) GROUP BY 1 HAVING count(*) > 1",
        "gapped_subsequence": f"""
WITH RECURSIVE {_HASH}, q AS (SELECT node_id, list(page_hash ORDER BY page_num) AS s FROM h GROUP BY 1), pr AS (SELECT DISTINCT id AS small_id, next_id AS big_id FROM nodes WHERE next_id IS NOT NULL),
j AS (SELECT small_id, big_id, coalesce(x.s, []) AS a, coalesce(y.s, []) AS b FROM pr LEFT JOIN q x ON x.node_id = small_id LEFT JOIN q y ON y.node_id = big_id),
w AS (SELECT small_id, big_id, a, b, 0 AS i, 0 AS k FROM j UNION ALL SELECT small_id, big_id, a, b, i + 1, CASE WHEN k < len(a) AND a[k + 1] = b[i + 1] THEN k + 1 ELSE k END FROM w WHERE i < len(b))
SELECT small_id, big_id, max(k) = any_value(len(a)) AS is_subsequence FROM w GROUP BY 1, 2""",
        "attempt_numbers": f"WITH {_ATTEMPTS} SELECT id, CAST(row_number() OVER (PARTITION BY document_id, page_number, stage ORDER BY id) AS INT) AS attempt_index FROM att",
        "attempt_latest": f"WITH {_ATTEMPTS} SELECT la.document_id, la.page_number, la.stage, la.attempt_count, att.status, att.model_name FROM la JOIN att ON att.id = la.mid",
        "ocr_state_completion": f"WITH {_ATTEMPTS}, s AS (SELECT la.document_id, att.status FROM la JOIN att ON att.id = la.mid) SELECT document_id, count(*) AS total_pages, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) > 0 AND count(*) FILTER (WHERE status = 'completed') = count(*) AS is_completed FROM s GROUP BY 1",
        "skip_pages": """
WITH p AS (SELECT DISTINCT document_id, pdf_page_num, page_id, incomplete_text FROM split_pages), done AS (SELECT * FROM p WHERE NOT coalesce(incomplete_text, false))
SELECT p.document_id, count(*) AS n_pages, count(*) FILTER (WHERE d.page_id = p.page_id) AS n_skipped FROM p LEFT JOIN done d ON d.document_id = p.document_id AND d.pdf_page_num = p.pdf_page_num GROUP BY 1""",
        "candidate_ladder": f"""
WITH {_ATTEMPTS}, c AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY id) - 1 AS k FROM att)
SELECT document_id, page_number, arg_min_null(model_name, CASE WHEN status = 'completed' THEN k END) AS model_name, coalesce(min(CASE WHEN status = 'completed' THEN k END), count(*)) AS n_failed, bool_or(status = 'completed') AS succeeded FROM c GROUP BY 1, 2""",
        "progress_export": f"WITH {_ATTEMPTS} SELECT la.document_id, la.page_number, '' AS image_sha256, 'page_' || la.page_number || '.json' AS json_path, att.status FROM la JOIN att ON att.id = la.mid WHERE la.stage = 'ocr' AND att.status = 'completed'",
        "input_fingerprints": "SELECT count(DISTINCT document_id) AS n_documents, count(DISTINCT document_id) AS n_fingerprints FROM split_pages",
        "event_cost": f"WITH {_EVENTS} SELECT id, regexp_replace(model_name, '^models/', '') AS model, round(token_count * 0.00000125 / 1000, 12) AS cost, false AS priced FROM ev WHERE event_name = 'llm_end'",
        "listed_prices": f"""
WITH {_EVENTS}, pr(model_name, i, o, c) AS (VALUES ('gemini-3-flash-preview', 0.0005, 0.003, 0.0), ('gemini-3.0-pro', 0.002, 0.012, 0.00031), ('gemini-2.0-flash', 0.0001, 0.0004, 0.0), ('gemini-1.5-pro', 0.00125, 0.005, 0.0), ('gemini-2.5-flash-preview-04-17', 0.00015, 0.0035, 0.0000375),
  ('gemini-2.5-flash', 0.0003, 0.0025, 0.0000375), ('gemini-2.5-pro-preview-03-25', 0.00125, 0.01, 0.00031), ('gemini-2.5-pro', 0.00125, 0.01, 0.00031), ('models/gemini-2.5-pro', 0.00125, 0.01, 0.00031), ('gemini-2.5-flash-lite', 0.0001, 0.004, 0.00025), (NULL, 0.00000125, 0.000005, 0.0)),
n AS (SELECT CAST(floor(avg(token_count)) AS BIGINT) AS n FROM ev WHERE event_name = 'llm_end'), t(a, b, d) AS (VALUES (1, 0, 0), (0, 1, 0), (1, 0, 1), (2, 1, 1))
SELECT model_name, n * a AS input_tokens, n * b AS output_tokens, n * d AS cached_tokens, round(CAST(n * (a - d) * i + n * d * c + n * b * o AS DOUBLE) / 1000, 9) AS cost, model_name IS NOT NULL AS priced FROM pr, n, t""",
        "usage_by_model": f"WITH {_EVENTS} SELECT regexp_replace(model_name, '^models/', '') AS model, count(*) AS n_events, count(*) FILTER (WHERE event_name = 'llm_end') AS n_calls, count(*) FILTER (WHERE event_name = 'llm_error') AS n_errors, CAST(sum(token_count) AS BIGINT) AS tokens, CAST(round(sum(CAST(cost_usd AS DECIMAL(24,10))), 6) AS DOUBLE) AS cost FROM ev GROUP BY 1",
        "events_by_run": f"WITH {_EVENTS} SELECT run_id, count(*) AS n_events, min(id) AS first_id, max(id) AS last_id, arg_max(event_name, id) AS last_event FROM ev GROUP BY 1",
        "event_windows": f"WITH {_EVENTS} SELECT strftime(CAST(try_cast(ts_iso AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP), '%Y-%m-%d %H') AS hour, event_name, count(*) AS n_events, CAST(sum(token_count) AS BIGINT) AS tokens FROM ev WHERE try_cast(ts_iso AS TIMESTAMPTZ) IS NOT NULL GROUP BY 1, 2",
        "stream_event_counts": "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1",
        "token_estimate": f"SELECT doc_id, {_TOK.format('text')} AS tokens, {_words(chr(99) + 'oalesce(text, ' + chr(39) * 2 + ')')} AS n_words FROM documents",
        "greedy_batches": f"""
WITH RECURSIVE d AS (SELECT collection_id, doc_id, {_TOK.format("text")} AS tokens, row_number() OVER (PARTITION BY collection_id ORDER BY doc_id) AS k FROM documents WHERE collection_id IS NOT NULL),
w AS (SELECT collection_id, doc_id, tokens, k, 0 AS batch, 450 + tokens + 15 AS used FROM d WHERE k = 1
  UNION ALL SELECT d.collection_id, d.doc_id, d.tokens, d.k, CASE WHEN w.used + d.tokens + 15 > 13500 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.used + d.tokens + 15 > 13500 THEN 450 ELSE w.used END + d.tokens + 15 FROM w JOIN d ON d.collection_id = w.collection_id AND d.k = w.k + 1)
SELECT collection_id, doc_id, tokens, batch FROM w""",
        "index_entries": f"WITH {_TREE} SELECT node_id, substring(coalesce(title, ''), 1, 120) AS title, least(12, len(list_distinct(list_filter(regexp_split_to_array(lower(coalesce(title, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 2)))) AS n_keywords, {_TOK.format('title')} AS tokens FROM n",
        "short_ids": f"WITH {_TREE} SELECT node_id, 'nid:' || row_number() OVER (PARTITION BY document_id ORDER BY ord, node_id) || ':' || coalesce(title, '') AS short_id FROM n WHERE document_id IS NOT NULL",
        "clipped_texts": "SELECT doc_id, left(regexp_replace(text, '[0-9]+', '█', 'g'), 200) AS clipped FROM documents",
        "fake_embedding": f"WITH v AS (SELECT doc_id, length(coalesce(title, '')) AS n, CAST(coalesce({_chars('title')}, 0) AS BIGINT) AS s FROM documents) SELECT doc_id, CAST((n + 1) % 97 + 1 + s % 13 AS DOUBLE) AS v0, CAST((n + 51) % 97 + 1 + s % 13 AS DOUBLE) AS v50, CAST((n + 100) % 97 + 1 + s % 13 AS DOUBLE) AS v99, CAST(s % 97 + 1 AS DOUBLE) AS tiny FROM v",
        "search_descriptors": r"SELECT doc_id, len(list_filter(regexp_split_to_array(lower(coalesce(title, '')), '[^\p{L}\p{N}_]+'), lambda w: w <> '')) AS n_title_tokens, len(regexp_extract_all(coalesce(text, ''), '\d+(?:\.\d+)?')) AS n_numbers, len(regexp_extract_all(coalesce(text, ''), '\d{1,2}/\d{1,2}/\d{2,4}')) AS n_dates, least(3000, length(coalesce(text, ''))) AS excerpt_chars FROM documents",
        "unit_pages": r"SELECT CAST(regexp_extract(source_cluster_id, '(?:^|\|)p(\d+)_', 1) AS INT) AS page, count(*) AS n, count(*) FILTER (WHERE end_char = -1 OR end_char >= 100000000) AS n_open FROM node_pointers WHERE source_cluster_id IS NOT NULL GROUP BY 1",
        "fuzzy_thresholds": "SELECT CASE WHEN length(verbatim_text) <= 10 THEN NULL WHEN length(verbatim_text) <= 20 THEN 0.99::DOUBLE WHEN length(verbatim_text) <= 50 THEN 0.95 WHEN length(verbatim_text) <= 100 THEN 0.9 ELSE 0.85 END AS threshold, CASE WHEN length(verbatim_text) < 30 THEN 100 WHEN length(verbatim_text) < 60 THEN 98 ELSE 95 END AS preserve, count(*) AS n FROM node_pointers WHERE verbatim_text IS NOT NULL GROUP BY 1, 2",
        "ground_pointers": _GROUND + """
SELECT g4.node_id, g4.ptr_ord, g4.source_cluster_id, CASE WHEN t0 <> 'open' THEN t0 WHEN pos IS NOT NULL THEN 'search' ELSE 'lost' END AS tier,
  CAST(CASE WHEN t0 = 'same' THEN g4.start_char WHEN t0 = 'contain' THEN greatest(g4.start_char, 0) WHEN t0 = 'open' THEN pos END AS INT) AS new_start, CAST(CASE WHEN t0 = 'same' THEN end_char WHEN t0 = 'contain' THEN greatest(past - 1, -1) WHEN t0 = 'open' THEN pos + length(g4.v) - 1 END AS INT) AS new_end
FROM g4 LEFT JOIN best b ON b.node_id = g4.node_id AND b.ptr_ord = g4.ptr_ord AND b.source_cluster_id = g4.source_cluster_id AND b.start_char IS NOT DISTINCT FROM g4.start_char AND b.v = g4.v AND g4.t0 = 'open'""",
        "layer_repair": _GROUND + """,
v4 AS (SELECT g4.node_id, g4.verbatim_text, g4.end_char, g4.actual, CASE WHEN t0 <> 'open' THEN t0 WHEN pos IS NOT NULL THEN 'search' ELSE 'lost' END AS tier, greatest(past - 1, -1) AS ne
  FROM g4 LEFT JOIN best b ON b.node_id = g4.node_id AND b.ptr_ord = g4.ptr_ord AND b.source_cluster_id = g4.source_cluster_id AND b.start_char IS NOT DISTINCT FROM g4.start_char AND b.v = g4.v AND g4.t0 = 'open')
SELECT node_id, count(*) AS n_pointers, count(*) FILTER (WHERE tier = 'search' OR (tier = 'contain' AND (actual <> coalesce(verbatim_text, '') OR ne <> end_char))) AS n_changed, bool_and(tier NOT IN ('lost', 'unknown')) AS repaired FROM v4 GROUP BY 1""",
        "legacy_unit_ids": "SELECT DISTINCT node_id, ptr_ord, CASE WHEN EXISTS (SELECT 1 FROM text_clusters t WHERE t.document_id || '|p' || t.pdf_page_num || '_t' || t.cluster_number = source_cluster_id) THEN source_cluster_id ELSE replace(split_part(source_cluster_id, '|', 2), '_t', '_c') END AS source_cluster_id FROM node_pointers WHERE source_cluster_id IS NOT NULL",
        "legacy_units": """
WITH s AS (SELECT DISTINCT document_id, pdf_page_num, OCR_text_clusters AS t, non_text_objects AS o FROM split_pages)
SELECT document_id, 'p' || pdf_page_num || '_c' || (i - 1) AS unit_id, 'text' AS kind FROM (SELECT document_id, pdf_page_num, unnest(range(1, len(t) + 1)) AS i FROM s) UNION ALL SELECT document_id, 'p' || pdf_page_num || '_c' || (i - 1), 'object' FROM (SELECT document_id, pdf_page_num, unnest(range(1, len(o) + 1)) AS i FROM s)""",
        "mention_pointers": f"WITH {_PTR} SELECT node_id, ptr_ord, source_cluster_id, start_char, greatest(end_char + 1, start_char + greatest(length(coalesce(verbatim_text, '')), 1)) - 1 AS end_char FROM q SEMI JOIN semantic_nodes USING (node_id) WHERE start_char IS NOT NULL AND end_char IS NOT NULL AND source_cluster_id IS NOT NULL",
        "flags_as_words": "SELECT CASE WHEN contains_table THEN 'Yes' WHEN NOT contains_table THEN 'No' END AS contains_table, CASE WHEN incomplete_text THEN 'Yes' WHEN NOT incomplete_text THEN 'No' END AS incomplete_text, count(*) AS n FROM (SELECT DISTINCT page_id, contains_table, incomplete_text FROM split_pages) GROUP BY 1, 2",
        "delimiter_resolve": rf"""
WITH {_PAGES}, z AS (SELECT doc_id, page_number, page_text AS t, list_filter(string_split(page_text, chr(10)), lambda x: {_strip("x")} <> '') AS ls FROM p),
y AS (SELECT doc_id, page_number, t, ls[1] AS f, ls[-1] AS l, (length(t) - length(replace(t, ls[1], ''))) / length(ls[1]) AS nf, (length(t) - length(replace(t, ls[-1], ''))) / length(ls[-1]) AS nl FROM z),
x AS (SELECT *, CASE WHEN nf = 0 THEN 'start not found' WHEN nf > 1 THEN 'start is not unique' WHEN nl = 0 THEN 'end not found' WHEN nl > 1 THEN 'end is not unique' WHEN strpos(t, l) + length(l) - 2 < strpos(t, f) - 1 THEN 'end before start' END AS error FROM y)
SELECT doc_id, page_number, CASE WHEN error IS NULL THEN CAST(strpos(t, f) - 1 AS INT) END AS span_start, CASE WHEN error IS NULL THEN CAST(strpos(t, l) + length(l) - 2 AS INT) END AS span_end, error FROM x""",
        "leaf_completeness": f"""
WITH {_BLOCKS}, lf AS (SELECT b.doc_id, string_agg(substring(page_text, CAST(start_char + 1 AS BIGINT), CAST(end_char - start_char + 1 AS BIGINT)), '' ORDER BY b.page_number, seq) AS t FROM b JOIN p ON p.doc_id = b.doc_id AND p.page_number = b.page_number GROUP BY 1),
wh AS (SELECT doc_id, string_agg(page_text, '' ORDER BY page_number) AS t FROM p GROUP BY 1) SELECT doc_id, {_squeeze("wh.t")} = {_squeeze("lf.t")} AS complete FROM wh LEFT JOIN lf USING (doc_id)""",
    }
    out["validation_gate"] = f"WITH c AS ({out['overall_coverage']}) SELECT coverage, coverage >= 0.99 AS passed, CASE WHEN coverage < 0.99 THEN printf('text coverage below threshold: %.3f < %.3f', coverage, 0.99) END AS error FROM c"
    out["review_layer"] = f"""
WITH so AS ({out["sibling_overlaps"]}), dc AS ({out["duplicate_children"]}), cg AS ({out["coverage_gaps"]}), o AS (SELECT DISTINCT node_id, document_id FROM semantic_nodes WHERE document_id IS NOT NULL),
x AS (SELECT parent_id, 1 AS a, 0 AS b, 0 AS c FROM so UNION ALL SELECT parent_id, 0, 1, 0 FROM dc UNION ALL SELECT parent_id, 0, 0, 1 FROM cg), y AS (SELECT document_id, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM x JOIN o ON o.node_id = x.parent_id GROUP BY 1)
SELECT document_id AS collection_id, coalesce(a + b + c, 0) = 0 AS satisfied, coalesce(c, 0) = 0 AS coverage_ok, CAST(coalesce(a, 0) AS BIGINT) AS n_overlaps, CAST(coalesce(c, 0) AS BIGINT) AS n_gaps, 1 AS tries FROM (SELECT DISTINCT document_id FROM o) LEFT JOIN y USING (document_id)"""
    return out
