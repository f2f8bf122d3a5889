"""Named queries of the core: (session, folder of tables) to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window

from ..functions import text as X
from ..operators import batching, graph, grounding, hierarchy, intervals, layers, legacy, nested, segment, session, state, telemetry, units, versions
from ..session import cut
from ..sources.tables import read_table as read


def p2_found(spark, base) -> DataFrame:
    """Every child object of pages and responses with the object that holds it."""
    return nested.child_objects(read(spark, base, "split_pages"), read(spark, base, "raw_ocr_responses"))


def p2_pages(spark, base) -> DataFrame:
    """One row per page."""
    return nested.page_table(read(spark, base, "split_pages"))


def p2_texts(spark, base) -> DataFrame:
    """Text boxes with their text and place."""
    raw = nested.json_objects(read(spark, base, "raw_ocr_responses")).withColumnRenamed("kind", "origin")
    return nested.refined_children(read(spark, base, "split_pages")).unionByName(raw).where("origin IN ('refined_text', 'raw_text')").distinct()


def p2_objects(spark, base) -> DataFrame:
    """Other objects with their description, place and parent."""
    raw = nested.json_objects(read(spark, base, "raw_ocr_responses")).withColumnRenamed("kind", "origin")
    return nested.refined_children(read(spark, base, "split_pages")).unionByName(raw).where("origin IN ('refined_object', 'raw_object')").distinct()


def p3_found(spark, base) -> DataFrame:
    """Nodes and runs whose line of parents runs into a loop."""
    return hierarchy.loop_members(read(spark, base, "semantic_nodes", "node_id", "parent_id"), read(spark, base, "ingest_events", "run_id", "parent_run_id"))


def _trees(spark, base, form=hierarchy.hierarchy):
    yield "node", form(hierarchy.links(read(spark, base, "semantic_nodes", "node_id", "parent_id"), "node_id", "parent_id"))
    yield "run", form(hierarchy.links(read(spark, base, "ingest_events", "run_id", "parent_run_id"), "run_id", "parent_run_id"))


def p3_hierarchy(spark, base) -> DataFrame:
    """Path, depth, root and number of descendants of every node and run outside loops."""
    out = None
    for tree, h in _trees(spark, base):
        part = h.select(F.lit(tree).alias("tree"), F.col("id").alias("member_id"), "root", "depth", "path", "n_descendants")
        out = part if out is None else out.unionByName(part)
    return out


def p3_tours(spark, base) -> DataFrame:
    """Entry and exit of every node and run in the tour of its tree: descendants lie between."""
    out = None
    for tree, h in _trees(spark, base, hierarchy.tours):
        part = h.select(F.lit(tree).alias("tree"), F.col("id").alias("member_id"), "root", "entry", "exit")
        out = part if out is None else out.unionByName(part)
    return out


def p3_descendants(spark, base) -> DataFrame:
    """All pairs of ancestor and descendant."""
    out = None
    for tree, h in _trees(spark, base):
        part = hierarchy.descendants(h).select(F.lit(tree).alias("tree"), "ancestor", "descendant")
        out = part if out is None else out.unionByName(part)
    return out


def p6_found(spark, base) -> DataFrame:
    """Merged reported spans and the gaps between pointers, per source unit."""
    return intervals.pointer_stretches(
        read(spark, base, "node_pointers"), read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number", "text"), read(spark, base, "layer_notes")
    )


def p6_merged(spark, base) -> DataFrame:
    """The continuous stretches that pointers cover, per source unit, open ends included."""
    return intervals.merged_pointers(read(spark, base, "node_pointers", "source_cluster_id", "start_char", "end_char"), read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number", "text"))


# sources and units


def _unit_key() -> F.Column:
    return F.format_string("%s|p%d_t%d", "document_id", "pdf_page_num", "cluster_number").alias("source_cluster_id")


def _cluster_units(spark, base) -> DataFrame:
    c = read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number", "text")
    return c.where("document_id IS NOT NULL").select(_unit_key(), "text").distinct()


def units_from_documents(spark, base) -> DataFrame:
    """Documents as units with ids and the text the parser sees."""
    u = units.records(units.with_unit_ids(units.text_units(read(spark, base, "documents", "doc_id", "text")), ["cluster_number"]))
    return u.select("unit_id", "modality", "in_text", F.length("parser_text").alias("n_chars"))


def units_from_ocr(spark, base) -> DataFrame:
    """Clusters and objects of OCR pages as units."""
    u = units.with_unit_ids(units.ocr_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects")), ["cluster_number"])
    return units.records(u).select("unit_id", "modality", "embedding_space", "in_text", F.length("parser_text").alias("n_chars"))


def units_from_pages(spark, base) -> DataFrame:
    """Pages of documents as units without numbers: the ordinal on the page stands in."""
    p = segment.pages(read(spark, base, "documents", "doc_id", "text", "source_format"))
    u = p.select(F.col("doc_id").cast("string").alias("collection_id"), "page_number", F.lit(None).cast("int").alias("cluster_number"), F.lit("text").alias("modality"), F.col("page_text").alias("text"), F.lit(None).cast("string").alias("description"))
    return units.with_unit_ids(u, ["text"]).select("unit_id", F.length("text").alias("n_chars"))


def unit_id_collisions(spark, base) -> DataFrame:
    """Unit ids that several stored rows have."""
    c = read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number")
    return units.collisions(c.select(_unit_key().alias("unit_id")))


def unit_validity(spark, base) -> DataFrame:
    """How many units of each kind say something."""
    u = units.quarantine(units.ocr_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects")))
    return u.groupBy("modality", "valid").agg(F.count(F.lit(1)).alias("n"))


def page_validity(spark, base) -> DataFrame:
    """Rules that pages keep or break."""
    return units.page_checks(read(spark, base, "split_pages", "page_id", "OCR_text_clusters", "non_text_objects", "meaningful_ordering", "is_empty_page"))


def page_text_in_order(spark, base) -> DataFrame:
    """The text of every page in its meaningful order."""
    return units.page_text(read(spark, base, "split_pages", "page_id", "OCR_text_clusters", "meaningful_ordering"))


def mode_projection(spark, base) -> DataFrame:
    """What a model may see of the units."""
    return units.view(units.records(units.with_unit_ids(units.text_units(read(spark, base, "documents", "doc_id", "text")), ["cluster_number"])), "llm")


def raw_boxes(spark, base) -> DataFrame:
    """Boxes of the raw responses with named bounds, summed up per kind."""
    o = nested.json_objects(read(spark, base, "raw_ocr_responses")).distinct()
    return o.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("y_max") >= F.col("y_min")).cast("long")).alias("n_ordered"))


def embedding_space_counts(spark, base) -> DataFrame:
    """Vectors per space and their dimension."""
    e = read(spark, base, "embeddings", "label", "embedding")
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("embedding")).alias("dims"))


# segmentation


def _texts(spark, base) -> DataFrame:
    return read(spark, base, "documents", "doc_id", "text", "source_format")


def _pages(spark, base) -> DataFrame:
    return segment.pages(_texts(spark, base))


def document_pages(spark, base) -> DataFrame:
    """Pages of every document."""
    return _pages(spark, base).select("doc_id", "page_number", F.length("page_text").alias("n_chars"))


def line_offsets(spark, base) -> DataFrame:
    """Every line with its offset in the page."""
    return segment.lines(_texts(spark, base)).select("doc_id", "page_number", "line_no", "start", F.length("line").alias("n_chars"))


def block_types(spark, base) -> DataFrame:
    """Type, level and title of every line that isn't blank."""
    return segment.typed_lines(_texts(spark, base)).where("node_type <> 'BLANK'").select("doc_id", "page_number", "line_no", "node_type", "level", "title")


def paragraph_groups(spark, base) -> DataFrame:
    """Blocks with their spans."""
    return segment.blocks(_texts(spark, base)).select("doc_id", "page_number", "seq", "node_type", F.col("start").cast("long").alias("start_char"), F.col("end").cast("long").alias("end_char"), "n_lines")


def heading_parents(spark, base) -> DataFrame:
    """The heading every block stands under."""
    return segment.blocks(_texts(spark, base)).select("doc_id", "page_number", "seq", "level", "parent_seq")


def page_index_nodes(spark, base) -> DataFrame:
    """The page index of every document as an adjacency table."""
    return segment.page_index(read(spark, base, "documents", "doc_id", "text", "source_format")).select("node_id", "parent_id", "node_type", "title", "start_char", "end_char")


def page_index_summary(spark, base) -> DataFrame:
    """Per document: pages, nodes, node types, and the most children a page has."""
    b = segment.blocks(_texts(spark, base))
    up = F.col("parent_seq").isNull()
    per = b.groupBy("doc_id", "page_number").agg(F.count(F.lit(1)).alias("n"), F.count_if(up).alias("kids"), F.collect_set("node_type").alias("types"))
    doc = per.groupBy("doc_id").agg(F.sum("n").alias("n"), F.max("kids").alias("kids"), F.size(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"))
    p = _pages(spark, base).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"))
    j = p.join(doc, "doc_id", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    return j.select("doc_id", "n_pages", (F.col("n_pages") + z("n") + 1).alias("n_nodes"), (z("types") + 2).cast("long").alias("n_types"), z("kids").alias("max_page_children"))


def strict_spans(spark, base) -> DataFrame:
    """Blocks of every page grounded one after another from a running cursor."""
    return segment.strict_spans(_texts(spark, base))


def fallback_tree(spark, base) -> DataFrame:
    """The tree without a parser: pages and one node per text unit."""
    u = units.with_unit_ids(units.ocr_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects")), ["cluster_number"])
    return segment.fallback_tree(u)


def flagship(spark, base) -> DataFrame:
    """Per source: documents, pages, blocks of each type, and the share of characters that blocks cover."""
    docs = read(spark, base, "documents", "doc_id", "text", "source_format", "source")
    p, b = segment.pages(docs), segment.blocks(docs)
    per = b.groupBy("doc_id").agg(*[F.count_if(F.col("node_type") == t).alias(f"n_{t.lower()}") for t in ("SECTION", "SUBSECTION", "PARAGRAPH", "TERM")], F.sum(F.col("end") - F.col("start") + 1).alias("covered"))
    size = p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("page_text")).alias("total"))
    j = docs.select("doc_id", "source").join(size, "doc_id", "left").join(per, "doc_id", "left")
    z = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), z("n_pages"), z("n_section"), z("n_subsection"), z("n_paragraph"), z("n_term"), F.round(F.sum("covered") / F.sum("total"), 9).alias("coverage"))


# spans and grounding


def _resolved(spark, base) -> DataFrame:
    """Distinct pointers with known units, ends resolved and clipped."""
    u = _cluster_units(spark, base).where("text IS NOT NULL AND text <> ''").select("source_cluster_id", F.length("text").alias("n"))
    p = read(spark, base, "node_pointers", "node_id", "ptr_ord", "source_cluster_id", "start_char", "end_char", "verbatim_text").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL")
    e = X.open_end("end_char")
    return p.join(u, "source_cluster_id").withColumn("end_char", F.when(e == -1, F.col("n") - 1).otherwise(F.least(e, F.col("n") - 1))).where("start_char <= end_char")


def interval_islands(spark, base) -> DataFrame:
    """Continuous stretches that pointers cover, per unit."""
    return intervals.merge_intervals(_resolved(spark, base), ["source_cluster_id"], "start_char", "end_char").select("source_cluster_id", F.col("start_char").alias("span_start"), F.col("end_char").alias("span_end"))


def _coverage(spark, base) -> DataFrame:
    p = _resolved(spark, base)
    return intervals.coverage(p.drop("n"), p.select("source_cluster_id", "n").distinct(), "source_cluster_id", "start_char", "end_char", "n")


def span_coverage(spark, base) -> DataFrame:
    """Covered characters of every unit that pointers touch."""
    return _coverage(spark, base)


def overall_coverage(spark, base) -> DataFrame:
    """Covered over total characters of all units touched."""
    return intervals.cover_ratio(_coverage(spark, base)).select(F.round("coverage", 9).alias("coverage"))


def exact_occurrences(spark, base) -> DataFrame:
    """Non-overlapping places of each pointer's text in its unit."""
    p = read(spark, base, "node_pointers", "node_id", "ptr_ord", "source_cluster_id", "verbatim_text").where("verbatim_text <> ''").distinct()
    j = p.join(_cluster_units(spark, base).where("text IS NOT NULL"), "source_cluster_id")
    return j.select("node_id", "ptr_ord", "source_cluster_id", F.explode(X.occurrences("text", "verbatim_text")).alias("start_at"))


def nearest_occurrence(spark, base) -> DataFrame:
    """Of these the one nearest to the pointer's start."""
    p = read(spark, base, "node_pointers", "node_id", "ptr_ord", "source_cluster_id", "start_char", "verbatim_text").where("verbatim_text <> '' AND start_char IS NOT NULL").distinct()
    j = p.join(_cluster_units(spark, base).where("text IS NOT NULL"), "source_cluster_id")
    return j.select("node_id", "ptr_ord", "source_cluster_id", "start_char", X.nearest(X.occurrences("text", "verbatim_text"), F.col("start_char")).alias("start_at")).where("start_at IS NOT NULL")


def _grounded(spark, base) -> DataFrame:
    p = read(spark, base, "node_pointers").distinct()
    return grounding.ground(p, _cluster_units(spark, base))


def ground_pointers(spark, base) -> DataFrame:
    """Every pointer with the tier that anchors it and its repaired span."""
    return _grounded(spark, base).select("node_id", "ptr_ord", "source_cluster_id", "tier", "new_start", "new_end")


def layer_repair(spark, base) -> DataFrame:
    """Nodes with their pointers repaired, all or nothing."""
    return grounding.layer_repair(_grounded(spark, base))


def fuzzy_ground(spark, base) -> DataFrame:
    """Fuzzy spans for pointers whose texts were copied badly: every blank doubled, and in long ones the sixth character wrong."""
    p = read(spark, base, "node_pointers").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL AND verbatim_text <> ''")
    bad = F.when(F.length("verbatim_text") > 25, F.concat(F.substring("verbatim_text", 1, 5), F.lit("#"), F.substring(F.col("verbatim_text"), F.lit(7), F.length("verbatim_text")))).otherwise(F.col("verbatim_text"))
    return grounding.fuzzy_ground(p.withColumn("verbatim_text", F.replace(bad, F.lit(" "), F.lit("  "))), _cluster_units(spark, base))


def delimiter_resolve(spark, base) -> DataFrame:
    """Spans between the first and last line of every page, where both are unique on it."""
    p = _pages(spark, base)
    ls = F.filter(F.split("page_text", "\n"), lambda x: X.strip(x) != "")
    d = p.withColumns({"first_line": F.get(ls, F.lit(0)), "last_line": F.element_at(ls, -1)})
    return grounding.resolve_delimiters(d, "page_text", "first_line", "last_line").select("doc_id", "page_number", "span_start", "span_end", "error")


def leaf_completeness(spark, base) -> DataFrame:
    """Do the page index leaves of a document hold its whole text?"""
    docs = _texts(spark, base)
    p = segment.pages(docs)
    leaf = segment.blocks(docs, texts=True).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "seq", "said"))), lambda x: x["said"]), "").alias("text"))
    whole = p.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "page_text"))), lambda x: x["page_text"]), "").alias("text"))
    return grounding.completeness(leaf, whole, "doc_id").select("doc_id", "complete")


# layers


def _arrivals(n: DataFrame) -> DataFrame:
    """Semantic nodes with an arrival order."""
    return n.withColumn("ord", F.coalesce(F.regexp_extract("node_id", r"(\d+)$", 1).try_cast("int"), F.lit(0)))


def _tree(spark, base) -> DataFrame:
    """Distinct semantic nodes with an arrival order."""
    return _arrivals(read(spark, base, "semantic_nodes").distinct())


def _child_pointers(spark, base) -> DataFrame:
    """Pointers of the nodes with a parent; each has an order of its own within the parent."""
    n = _tree(spark, base).where("parent_id <> ''").select("parent_id", F.col("node_id").alias("child_id"), F.col("ord").alias("node_ord"))
    p = _resolved(spark, base).select(F.col("node_id").alias("child_id"), "ptr_ord", "source_cluster_id", "start_char", "end_char", "verbatim_text")
    return n.join(p, "child_id").withColumn("ord", F.col("node_ord").cast("long") * 1000 + F.col("ptr_ord"))


def sibling_overlaps(spark, base) -> DataFrame:
    """Overlaps and duplicates between the pointers of siblings."""
    return layers.span_overlaps(_child_pointers(spark, base))


def duplicate_children(spark, base) -> DataFrame:
    """Children that repeat an earlier sibling."""
    n = _tree(spark, base).where("parent_id <> ''").select("parent_id", F.col("node_id").alias("child_id"), "title", "ord")
    p = read(spark, base, "node_pointers").distinct().select(F.col("node_id").alias("child_id"), "ptr_ord", "source_cluster_id", "start_char", "end_char", F.coalesce("verbatim_text", F.lit("")).alias("verbatim_text"))
    return layers.duplicate_children(n, p)


def coverage_gaps(spark, base) -> DataFrame:
    """What children leave out of their parent's spans."""
    parents = _resolved(spark, base).select(F.col("node_id").alias("parent_id"), "source_cluster_id", "start_char", "end_char")
    return layers.layer_gaps(parents, _child_pointers(spark, base), _cluster_units(spark, base).where("text IS NOT NULL"))


def overlap_tolerance(spark, base) -> DataFrame:
    """Pointers that reach more than eight characters into what earlier ones of the unit cover."""
    p = _resolved(spark, base).select("source_cluster_id", "start_char", "end_char").distinct()
    return intervals.overlap_tolerance(p, ["source_cluster_id"], "start_char", "end_char", 8).select("source_cluster_id", "start_char", "end_char", "prior_end")


def _with_spans(spark, base) -> DataFrame:
    p = read(spark, base, "node_pointers").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL")
    s = p.groupBy("node_id").agg(F.collect_list(F.concat_ws(":", "source_cluster_id", "start_char", "end_char")).alias("spans"))
    return _tree(spark, base).join(s, "node_id", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<string>")))


def level_dedupe(spark, base) -> DataFrame:
    """The first node of each type, title and set of spans, within a document."""
    n = _with_spans(spark, base).withColumn("spans", F.concat(F.array("document_id"), "spans"))
    return layers.level_dedupe(n, "spans").select("node_id", "node_type")


def layer_dedupe(spark, base) -> DataFrame:
    """Children that neither repeat a sibling's title and type nor their parent's title."""
    n = _tree(spark, base)
    return layers.layer_dedupe(n.where("parent_id <> ''"), n).select("node_id", "parent_id")


def mirror_guard(spark, base) -> DataFrame:
    """Inner nodes unlike every page and root in type, title and spans."""
    n = _with_spans(spark, base)
    return layers.mirror_guard(n.where("node_type NOT IN ('PAGE', 'DOCUMENT_ROOT')"), n.where("parent_id IS NULL OR parent_id = '' OR node_type = 'SECTION'"), "spans").select("node_id")


def type_guard(spark, base) -> DataFrame:
    """Children after the rule on nested key-value pairs."""
    n = _tree(spark, base)
    return layers.type_guard(n.where("parent_id <> ''"), n, coerce=True).select("node_id", "node_type")


def cud_apply(spark, base) -> DataFrame:
    """Edits on the pages: terms deleted, sections marked as edited, a summary node added per document."""
    n = _tree(spark, base)
    layer = n.select("node_id", "node_type", "title")
    gone = n.where("node_type = 'TERM'").select(F.lit("DELETE").alias("action"), "node_id", F.lit(None).cast("string").alias("node_type"), F.lit(None).cast("string").alias("title"))
    edit = n.where("node_type = 'SECTION'").select(F.lit("EDIT").alias("action"), "node_id", F.lit(None).cast("string").alias("node_type"), F.concat(F.lit("[edited] "), F.coalesce("title", F.lit(""))).alias("title"))
    add = n.where("document_id IS NOT NULL").select("document_id").distinct().select(F.lit("ADD").alias("action"), F.concat("document_id", F.lit("|summary")).alias("node_id"), F.lit("TEXT_FLOW").alias("node_type"), F.lit("Summary").alias("title"))
    return layers.apply_edits(layer, gone.unionByName(edit).unionByName(add))


def frontier_bfs(spark, base) -> DataFrame:
    """Depth of every node that a root reaches, and its place in that depth."""
    return layers.frontier(_arrivals(read(spark, base, "semantic_nodes")))  # repeated rows don't matter there


# the review session


def _session_units(spark, base) -> DataFrame:
    c = read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number", "text").where("document_id IS NOT NULL")
    return c.select(F.col("document_id").alias("collection_id"), _unit_key().alias("unit_id"), F.lit("ocr_text").alias("modality"), "text").distinct()


def init_session(spark, base) -> DataFrame:
    """The pointers of the roots that a parse begins with."""
    p = session.init_session(_session_units(spark, base))[1]
    return p.select("node_id", "ptr_ord", "source_cluster_id", "end_char", F.length("verbatim_text").alias("n_chars"))


def page_units_order(spark, base) -> DataFrame:
    """Place of every OCR unit in its document."""
    u = units.with_unit_ids(units.ocr_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects")), ["cluster_number"])
    return session.page_units(u).select("unit_id", "place")


def parser_inputs(spark, base) -> DataFrame:
    """Pages as the parser reads them, texts and numbers joined."""
    p = units.parser_input(read(spark, base, "split_pages", "document_id", "pdf_page_num", "printed_page_number", "contains_table", "OCR_text_clusters", "non_text_objects"))
    said = lambda c, f: F.array_join(F.transform(c, lambda o: o[f].cast("string")), "|")
    return p.select("document_id", "pdf_page_num", "contains_table", F.md5(said("texts", "text")).alias("texts"), said("texts", "cluster_number").alias("text_numbers"), said("objects", "description").alias("objects"), said("objects", "cluster_number").alias("object_numbers"))


def primary_collection(spark, base) -> DataFrame:
    """The first collection of the documents."""
    return units.primary(read(spark, base, "documents", "doc_id", "collection_id").where("collection_id IS NOT NULL").select("collection_id").distinct(), "collection_id")


def embedding_spaces(spark, base) -> DataFrame:
    """The spaces that every document's units are embedded in."""
    u = units.ocr_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects"))
    return units.embedding_spaces(u).select("collection_id", F.array_join("spaces", ",").alias("spaces"))


def refine_wanted(spark, base) -> DataFrame:
    """Pages whose tables are worth refining."""
    return units.refine_wanted(read(spark, base, "split_pages", "page_id", "contains_table", "OCR_text_clusters", "refined_version"))


def refine_gate(spark, base) -> DataFrame:
    """Do the refined versions hold all text of their pages?"""
    return units.refine_gate(read(spark, base, "split_pages", "page_id", "OCR_text_clusters", "refined_version"))


def _frontier_items(spark, base) -> DataFrame:
    n = _tree(spark, base).where("document_id IS NOT NULL AND level_from_root IS NOT NULL")
    return n.select(F.col("document_id").alias("collection_id"), F.col("node_id").alias("parent_node_id"), F.col("level_from_root").alias("depth"), F.col("ord").cast("long").alias("order"))


def _popped(spark, base) -> tuple[DataFrame, DataFrame]:
    p = read(spark, base, "node_pointers").distinct()
    return session.prepare_frontier(_frontier_items(spark, base), _tree(spark, base), p)


def prepare_frontier(spark, base) -> DataFrame:
    """The smallest depth of every document's nodes taken as a frontier, with titles and pointers."""
    return _popped(spark, base)[0]


def enqueue_next(spark, base) -> DataFrame:
    """That frontier after its first layer: the rest and the expandable children behind it."""
    layer, rest = _popped(spark, base)
    return session.enqueue(rest, cut(layer), _tree(spark, base).where("parent_id <> ''").select("parent_id", "node_id", "node_type", "ord"), 3)


def review_layer(spark, base) -> DataFrame:
    """Every document's tree taken as one layer, and what the invariants say of it."""
    n = _tree(spark, base)
    layer = n.where("document_id IS NOT NULL").select(F.col("document_id").alias("collection_id"), F.col("node_id").alias("parent_node_id"), F.lit(0).alias("depth"), F.lit(0).alias("retry_count"))
    kids = n.where("parent_id <> ''").select("parent_id", F.col("node_id").alias("child_id"), "title", "ord")
    spans = _resolved(spark, base).select(F.col("node_id").alias("parent_id"), "source_cluster_id", "start_char", "end_char")
    r = session.review_layer(layer, kids, cut(_child_pointers(spark, base)), spans, _cluster_units(spark, base).where("text IS NOT NULL"))
    return r.select("collection_id", "satisfied", "coverage_ok", "n_overlaps", "n_gaps", "tries")


def commit_layer(spark, base) -> DataFrame:
    """Roots and pages with all other nodes committed below them as one layer."""
    n = _tree(spark, base).select("node_id", F.nullif("parent_id", F.lit("")).alias("parent_id"), "node_type", "title", "level_from_root").distinct()
    top = n.where("node_type IN ('PAGE', 'DOCUMENT_ROOT')")
    return session.commit_layer(top, n.where("node_type NOT IN ('PAGE', 'DOCUMENT_ROOT')").drop("level_from_root")).select("node_id", "level_from_root")


def validation_gate(spark, base) -> DataFrame:
    """Would the tree pass at 99 of 100 characters covered?"""
    return session.validation_gate(intervals.cover_ratio(_coverage(spark, base))).select(F.round("coverage", 9).alias("coverage"), "passed", "error")


def prompt_view(spark, base) -> DataFrame:
    """Children as a model sees them: number, number of pointers shown and their clipped texts."""
    n = _tree(spark, base).where("parent_id <> ''")
    p = read(spark, base, "node_pointers", "node_id", "ptr_ord", "source_cluster_id", "start_char", "end_char", "verbatim_text").distinct()
    v = session.prompt_view(n, p)
    return v.select("parent_id", "local_id", "node_id", F.coalesce(F.size("pointers"), F.lit(0)).alias("n_shown"), F.md5(F.array_join(F.col("pointers.verbatim_text"), "|")).alias("shown"))


def unmatched_ids(spark, base) -> DataFrame:
    """Nodes with pointers that aren't in the tree, and nodes of the tree without any."""
    return session.unmatched_ids(read(spark, base, "node_pointers", "node_id"), read(spark, base, "semantic_nodes", "node_id"), "node_id")


def cud_loop(spark, base) -> DataFrame:
    """Children of every document edited in rounds: terms deleted by number and sections renamed by type and title, then a summary added, then nothing more."""
    n = _tree(spark, base).where("document_id IS NOT NULL AND parent_id <> ''").select(F.col("document_id").alias("collection_id"), "node_id", "parent_id", "node_type", "title", "ord")
    layer = session.within(n, "collection_id", ["ord", "node_id"], "local_id").select("collection_id", "local_id", "parent_id", "node_type", "title", F.array("node_id").alias("spans"))
    null = F.lit(None).cast("string")

    def propose(now: DataFrame, done: int) -> DataFrame:
        if done == 0:
            gone = now.where("node_type = 'TERM'").select("collection_id", F.col("local_id").alias("seq"), F.lit("DELETE_NODE").alias("edit_type"), F.col("local_id").cast("string").alias("target_id"), null.alias("target_type"), null.alias("target_title"), null.alias("parent_id"), null.alias("node_type"), null.alias("title"), F.lit(True).alias("valid"))
            name = now.where("node_type = 'SECTION'").select("collection_id", "title").distinct().select("collection_id", F.lit(0).cast("long").alias("seq"), F.lit("EDIT_NODE").alias("edit_type"), null.alias("target_id"), F.lit("SECTION").alias("target_type"), F.col("title").alias("target_title"), null.alias("parent_id"), null.alias("node_type"), F.concat(F.lit("[edited] "), F.lower(X.strip("title"))).alias("title"), F.lit(True).alias("valid"))
            return gone.unionByName(name)
        add = now.select("collection_id").distinct().select("collection_id", F.lit(0).cast("long").alias("seq"), F.lit("ADD_NODE").alias("edit_type"), null.alias("target_id"), null.alias("target_type"), null.alias("target_title"), null.alias("parent_id"), F.lit("TEXT_FLOW").alias("node_type"), F.lit("Summary").alias("title"), F.lit(True).alias("valid"))
        return add if done == 1 else add.limit(0)

    out, _ = session.edit_loop(layer, propose)
    return out.groupBy("collection_id", "node_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("title").startswith("[edited] ")).alias("n_edited"))


# graphs


def graph_nodes(spark, base) -> DataFrame:
    """Exported nodes with the number of their spans."""
    p = read(spark, base, "node_pointers").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL")
    return graph.graph_nodes(_tree(spark, base), p).select("id", "label", "semantic_node_type", "doc_id", F.size("mentions").alias("n_spans"), F.col("mentions")[0]["end_exclusive"].alias("first_end"))


def graph_edges(spark, base) -> DataFrame:
    """Exported parent-child edges."""
    return graph.graph_edges(read(spark, base, "semantic_nodes")).select("id", "relation", F.col("source_ids")[0].alias("source_id"), F.col("target_ids")[0].alias("target_id"), "doc_id")


def edge_spans(spark, base) -> DataFrame:
    """Spans on the edges: the child's, else the parent's."""
    p = read(spark, base, "node_pointers").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL")
    n = _tree(spark, base)
    e = graph.edge_spans(graph.graph_edges(n), graph.graph_nodes(n, p))
    return e.select("id", F.size("mentions").alias("n_spans"))


def legacy_graph_nodes(spark, base) -> DataFrame:
    """Nodes in the older form of export."""
    n, _ = graph.legacy_graph(_tree(spark, base), read(spark, base, "node_pointers").distinct())
    return n.select("id", "kind", F.md5("summary").alias("summary"), F.coalesce(F.size("mentions"), F.lit(0)).alias("n_spans"), F.col("mentions")[0]["page_number"].alias("first_page"))


def legacy_graph_edges(spark, base) -> DataFrame:
    """Edges in the older form of export, with their parents' spans."""
    _, e = graph.legacy_graph(_tree(spark, base), read(spark, base, "node_pointers").distinct())
    return e.select("id", "summary", F.coalesce(F.size("mentions"), F.lit(0)).alias("n_spans"))


def children_in_order(spark, base) -> DataFrame:
    """Every parent's children in arrival order."""
    n = _tree(spark, base).where("parent_id <> ''")
    return n.groupBy("parent_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "node_id"))), lambda x: x["node_id"]), ",").alias("children"))


def graph_roundtrip(spark, base) -> DataFrame:
    """The tree read back from its payload."""
    n = _tree(spark, base)
    return graph.tree_of(graph.graph_nodes(n, read(spark, base, "node_pointers").where("start_char IS NOT NULL AND end_char IS NOT NULL")), graph.graph_edges(n))


def temp_ids(spark, base) -> DataFrame:
    """Temporary ids of all nodes in id order."""
    return graph.with_temp_ids(read(spark, base, "semantic_nodes", F.col("node_id").alias("id")), "nn")


def temp_edges(spark, base) -> DataFrame:
    """Edges with temporary endpoints."""
    t = graph.with_temp_ids(read(spark, base, "semantic_nodes", F.col("node_id").alias("id")), "nn")
    e = graph.rewrite_edges(graph.graph_edges(read(spark, base, "semantic_nodes")), t)
    return e.select("id", F.col("source_ids")[0].alias("source_id"), F.col("target_ids")[0].alias("target_id"))


def insert_if_absent(spark, base) -> DataFrame:
    """Nodes below pages that a store of roots and pages lacks."""
    n = _tree(spark, base).select(F.col("node_id").alias("id"), "node_type")
    return graph.insert_if_absent(n.where("node_type IN ('PAGE', 'DOCUMENT_ROOT')"), n)


def digest_waves(spark, base) -> DataFrame:
    """Waves from the leaves up."""
    return graph.digest_waves(read(spark, base, "semantic_nodes"))


def digest_payload(spark, base) -> DataFrame:
    """The cheaper payload of every node."""
    p = read(spark, base, "node_pointers").distinct().where("verbatim_text IS NOT NULL").groupBy("node_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ptr_ord", "verbatim_text"))), lambda x: x["verbatim_text"]), "").alias("text"))
    return graph.digest_payload(_tree(spark, base).withColumn("parent_id", F.nullif("parent_id", F.lit(""))), p)


def export_bundle(spark, base) -> DataFrame:
    """Counts of every document's payload."""
    n = _tree(spark, base)
    return graph.export_bundle(graph.graph_nodes(n, read(spark, base, "node_pointers").where("start_char IS NOT NULL AND end_char IS NOT NULL")), graph.graph_edges(n))


# versions


def _hash_pages(spark, base) -> DataFrame:
    return versions.hash_pages(read(spark, base, "page_hashes", "node_id", "page_num", "page_hash"))


def hash_sequences(spark, base) -> DataFrame:
    """Pages of every file, numbered."""
    return _hash_pages(spark, base)


def containing_documents(spark, base) -> DataFrame:
    """Every place where a file stands in another."""
    return versions.contained(_hash_pages(spark, base))


def contained_documents(spark, base) -> DataFrame:
    """Pairs of a file and one that holds it."""
    return versions.contained(_hash_pages(spark, base)).select("small_id", "big_id").distinct()


def containment_duplicates(spark, base) -> DataFrame:
    """Contained files that count as duplicates."""
    p = cut(_hash_pages(spark, base))
    return versions.containment_duplicates(versions.contained(p), versions.page_counts(p))


def gapped_subsequence(spark, base) -> DataFrame:
    """Are a chain's neighbours ordered subsequences of each other, gaps allowed?"""
    n = read(spark, base, "nodes", "id", "next_id").where("next_id IS NOT NULL").distinct()
    return versions.gapped_subsequence(_hash_pages(spark, base), n.select(F.col("id").alias("small_id"), F.col("next_id").alias("big_id")))


def page_count_filters(spark, base) -> DataFrame:
    """Files of 10 pages and more."""
    return versions.page_counts(_hash_pages(spark, base)).where("n_pages >= 10")


def chain_order(spark, base) -> DataFrame:
    """Place of every file in its chain."""
    return versions.chain_positions(read(spark, base, "nodes", "id", "chain_id", "prev_id"))


def chain_relink(spark, base) -> DataFrame:
    """The chains without their files of unknown hash, relinked."""
    n = read(spark, base, "nodes", "id", "chain_id", "prev_id", "file_hash").distinct()
    return versions.delete_nodes(versions.chain_positions(n), n.where("file_hash IS NULL"))


def exact_duplicates(spark, base) -> DataFrame:
    """Files whose hash an earlier file has."""
    return versions.duplicates_by_hash(read(spark, base, "nodes", "id", "file_hash"))


def duplicate_texts(spark, base) -> DataFrame:
    """Documents whose text an earlier document has."""
    d = read(spark, base, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("h"))
    w = Window.partitionBy("h")
    return d.withColumn("first_id", F.min("doc_id").over(w)).where("doc_id <> first_id").select("doc_id", "first_id")


def _ledger(spark, base) -> DataFrame:
    n = read(spark, base, "nodes", "id", "file_path", "file_hash").distinct()
    return versions.duplicates_by_hash(n).join(n, ["id", "file_hash"]).select(F.col("file_path").alias("file_name"), "file_hash")


def canonical_files(spark, base) -> DataFrame:
    """Files that the duplicate ledger doesn't name."""
    return versions.canonical_files(read(spark, base, "nodes", "id", "file_path").distinct(), _ledger(spark, base)).select("id", "file_path")


def non_duplicate_hash(spark, base) -> DataFrame:
    """How many files' hashes a ledger lacks, with SQL's NOT IN: the duplicate ledger, the same with a null hash, and an empty one."""
    n, ledger = read(spark, base, "nodes", "id", "file_hash").distinct(), cut(_ledger(spark, base))
    null = ledger.limit(1).withColumn("file_hash", F.lit(None).cast("string"))
    out = None
    for name, held in (("as it is", ledger), ("with a null", ledger.unionByName(null)), ("empty", ledger.limit(0))):
        part = versions.non_duplicates_null_aware(n, held).agg(F.lit(name).alias("ledger"), F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))
        out = part if out is None else out.unionByName(part)
    return out


def canonical_page_stats(spark, base) -> DataFrame:
    """Pages of canonical files per chain."""
    c = versions.canonical_files(read(spark, base, "nodes", "id", "chain_id", "file_path").distinct(), _ledger(spark, base))
    j = c.join(versions.page_counts(_hash_pages(spark, base)).withColumnRenamed("node_id", "id"), "id")
    return j.groupBy("chain_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_pages").alias("n_pages"), F.max("n_pages").alias("most_pages"))


def missing_in_chain(spark, base) -> DataFrame:
    """Files that stand in no chain from its head on, once the files of unknown hash are gone from it, by name."""
    n = read(spark, base, "nodes", "id", "chain_id", "prev_id", "file_path", "file_hash").distinct()
    kept = n.where("file_hash IS NOT NULL").select("file_path").distinct()
    return n.select("file_path").distinct().join(kept, "file_path", "left_anti")


def chain_list(spark, base) -> DataFrame:
    """Every chain with its size, head and tail."""
    return versions.chain_list(versions.chain_positions(read(spark, base, "nodes", "id", "chain_id", "prev_id")))


def chain_apply(spark, base) -> DataFrame:
    """The chains with a file put behind the head of each, another before that one, and a chain of its own for a last file."""
    n = read(spark, base, "nodes", "id", "chain_id", "prev_id", "file_path").distinct()
    pos = cut(versions.chain_positions(n).join(n.select("id", "file_path"), "id"))
    head = pos.where("position = 0").select("chain_id", "file_path")
    first = head.groupBy("chain_id").agg(F.min("file_path").alias("p"))
    added = lambda tag, seq, prev, nxt: first.select((F.col("chain_id") * 2 + seq).alias("seq"), F.concat(F.lit(f"{tag}/"), F.col("chain_id").cast("string")).alias("file_path"), prev.cast("string").alias("prev"), nxt.cast("string").alias("next"))
    behind = added("behind", 0, F.col("p"), F.lit(None))
    before = added("before", 1, F.lit(None), F.concat(F.lit("behind/"), F.col("chain_id").cast("string")))
    own = spark.range(1).select(F.lit(-1).cast("long").alias("seq"), F.lit("own/0").alias("file_path"), F.lit(None).cast("string").alias("prev"), F.lit(None).cast("string").alias("next"))
    return versions.apply_additions(pos.select("chain_id", "file_path", "position"), behind.unionByName(before).unionByName(own))


def backfill_needs(spark, base) -> DataFrame:
    """Files without page hashes after a backfill that hashes the path of every PDF file without any: how many rows each had and has."""
    n, h = read(spark, base, "nodes", "id", "file_path"), read(spark, base, "page_hashes", "node_id", "page_num", "page_hash").where("page_num > 0").distinct()
    hook = lambda m: m.select("node_id", F.lit(0).alias("page_num"), F.sha2("file_path", 256).alias("page_hash"))
    return versions.backfill(n, h, hook).groupBy("node_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("page_num").alias("first_page"))


def duplicate_names(spark, base) -> DataFrame:
    """File names, without their folders, that several files have."""
    n = read(spark, base, "nodes", "id", "file_path").distinct().select(F.element_at(F.split("file_path", "/"), -1).alias("name"))
    return n.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# state and telemetry


def _attempt_log(spark, base) -> DataFrame:
    """Call ends and errors as attempts of a stage of a document."""
    e = telemetry.distinct_events(read(spark, base, "ingest_events")).where("document_id IS NOT NULL AND event_name IN ('llm_end', 'llm_error')")
    return e.select("id", "document_id", F.col("line_number").alias("page_number"), F.coalesce(F.get_json_object("metadata_json", "$.stage"), F.lit("none")).alias("stage"), "model_name", F.when(F.col("event_name") == "llm_end", "completed").otherwise("failed").alias("status"))


def attempt_numbers(spark, base) -> DataFrame:
    """Attempts numbered per document, page and stage."""
    return state.numbered_attempts(_attempt_log(spark, base), ["id"]).select("id", "attempt_index")


def attempt_latest(spark, base) -> DataFrame:
    """The last attempt per document, page and stage."""
    return state.latest(_attempt_log(spark, base), "id").select("document_id", "page_number", "stage", "attempt_count", "status", "model_name")


def ocr_state_completion(spark, base) -> DataFrame:
    """Which documents are done."""
    s = state.latest(_attempt_log(spark, base), "id")
    total = s.groupBy("document_id").agg(F.count(F.lit(1)).alias("total_pages"))
    return state.completion(s, total)


def skip_pages(spark, base) -> DataFrame:
    """Pages whose clusters a completed attempt already covers."""
    p = read(spark, base, "split_pages", "document_id", "pdf_page_num", "page_id", "incomplete_text").distinct()
    plan = p.select("document_id", F.col("pdf_page_num").alias("page_number"), F.lit("ocr").alias("stage"), F.col("page_id").cast("string").alias("content_hash"))
    done = p.where("NOT coalesce(incomplete_text, false)").select("document_id", F.col("pdf_page_num").alias("page_number"), F.lit("ocr").alias("stage"), F.lit("completed").alias("status"), F.col("page_id").cast("string").alias("content_hash"), F.lit("kept").alias("artifact_path"))
    return state.to_do(plan, done).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if("skip").alias("n_skipped"))


def candidate_ladder(spark, base) -> DataFrame:
    """Per document and page the first model in order that succeeded."""
    w = Window.partitionBy("document_id", "page_number").orderBy("id")
    return state.first_success(_attempt_log(spark, base).withColumn("candidate", F.row_number().over(w) - 1))


def progress_export(spark, base) -> DataFrame:
    """What is done of the OCR stage: pages with an artifact, which only completed ones have."""
    log = _attempt_log(spark, base).withColumn("artifact_path", F.when(F.col("status") == "completed", F.format_string("page_%d.json", "page_number"))).withColumn("content_hash", F.lit(None).cast("string"))
    return state.progress_export(state.latest(log, "id"))


def input_fingerprints(spark, base) -> DataFrame:
    """Fingerprint of every document's pages: as many distinct ones as documents."""
    p = read(spark, base, "split_pages", "document_id", "pdf_page_num", "page_id").distinct().select("document_id", F.col("pdf_page_num").alias("page_number"), F.col("page_id").cast("string").alias("content_hash"))
    f = state.fingerprint(p)
    return f.agg(F.count(F.lit(1)).alias("n_documents"), F.countDistinct("input_fingerprint").alias("n_fingerprints"))


def event_cost(spark, base) -> DataFrame:
    """Cost of every call's tokens, which the log doesn't split into input and output; its models have no listed price and cost the fallback."""
    e = telemetry.distinct_events(read(spark, base, "ingest_events")).where("event_name = 'llm_end'")
    calls = e.select("id", "model_name", F.col("token_count").alias("input_tokens"), F.lit(0).alias("output_tokens"), F.lit(0).alias("cached_tokens"))
    return telemetry.with_cost(calls, telemetry.price_table(spark)).select("id", telemetry.model_key("model_name").alias("model"), F.round("cost", 12).alias("cost"), "priced")


def listed_prices(spark, base) -> DataFrame:
    """Cost of the log's average call on every listed model, as input, output, cached input, and all of them; and of one without a name."""
    n = telemetry.distinct_events(read(spark, base, "ingest_events")).where("event_name = 'llm_end'").agg(F.floor(F.avg("token_count")).cast("long").alias("n"))
    models = spark.createDataFrame([(m,) for m in [*telemetry.PRICES, "models/gemini-2.5-pro", None]], "model_name string")
    t = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(o).alias("o"), F.lit(c).alias("c")) for i, o, c in ((1, 0, 0), (0, 1, 0), (1, 0, 1), (2, 1, 1))])).alias("t")
    calls = models.join(F.broadcast(n)).select("model_name", "n", t)  # one row beside a row per model
    calls = calls.select("model_name", *[(F.col("n") * F.col(f"t.{k}")).alias(c) for k, c in (("i", "input_tokens"), ("o", "output_tokens"), ("c", "cached_tokens"))])
    return telemetry.with_cost(calls, telemetry.price_table(spark)).select("model_name", "input_tokens", "output_tokens", "cached_tokens", F.round("cost", 9).alias("cost"), "priced")


def usage_by_model(spark, base) -> DataFrame:
    """Calls, tokens and cost per model."""
    e = telemetry.distinct_events(read(spark, base, "ingest_events")).withColumn("model", telemetry.model_key("model_name"))
    return telemetry.usage_totals(e, "model").withColumn("cost", F.round("cost", 6).cast("double"))


def events_by_run(spark, base) -> DataFrame:
    """Trace of every run."""
    return telemetry.run_trace(telemetry.distinct_events(read(spark, base, "ingest_events")))


def event_windows(spark, base) -> DataFrame:
    """Events per hour and name."""
    e = telemetry.event_time(telemetry.distinct_events(read(spark, base, "ingest_events"))).where("ts IS NOT NULL")
    return e.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "event_name").agg(F.count(F.lit(1)).alias("n_events"), F.sum("token_count").alias("tokens"))


def stream_event_counts(spark, base) -> DataFrame:
    """The stream of user events read to its end, counted per type."""
    from ..streaming.events import drain

    s = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").format("parquet").load(f"{base}/events.parquet*")
    g = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    import uuid

    from ..session import checkpoint_dir

    name = "stream_" + uuid.uuid4().hex
    return drain(g, name, f"{checkpoint_dir(spark)}/{name}")


# batches, functions


def token_estimate(spark, base) -> DataFrame:
    """Estimated tokens and words of every document."""
    return read(spark, base, "documents", "doc_id", "text").select("doc_id", X.token_estimate("text").alias("tokens"), X.n_words("text").alias("n_words"))


def greedy_batches(spark, base) -> DataFrame:
    """Documents of every collection packed into batches."""
    d = read(spark, base, "documents", "doc_id", "text", "collection_id").select("collection_id", "doc_id", X.token_estimate("text").alias("tokens"))
    return batching.greedy_batches(d, "collection_id", "doc_id", "tokens")


def index_entries(spark, base) -> DataFrame:
    """Index entries of the nodes."""
    n = _tree(spark, base)
    return batching.index_entries(n).select("node_id", "title", F.size("keywords").alias("n_keywords"), "tokens")


def short_ids(spark, base) -> DataFrame:
    """Short ids per document."""
    return batching.short_ids(_tree(spark, base).where("document_id IS NOT NULL"), "document_id", ["ord", "node_id"]).select("node_id", "short_id")


def clipped_texts(spark, base) -> DataFrame:
    """The first 200 characters of every document, numbers blotted out."""
    return read(spark, base, "documents", "doc_id", "text").select("doc_id", X.clip("text", 200, r"[0-9]+").alias("clipped"))


def fake_embedding(spark, base) -> DataFrame:
    """First, middle and last value of each document title's stand-in vector."""
    v = read(spark, base, "documents", "doc_id", "title").withColumn("v", X.hashed_embedding("title", 100))
    return v.select("doc_id", F.col("v")[0].alias("v0"), F.col("v")[50].alias("v50"), F.col("v")[99].alias("v99"), X.tiny_embedding("title")[1].alias("tiny"))


def search_descriptors(spark, base) -> DataFrame:
    """How many tokens, numbers and dates describe a document."""
    d = read(spark, base, "documents", "doc_id", "title", "text")
    t, n, k, e = X.descriptors("title", "text")
    return d.select("doc_id", F.size(t).alias("n_title_tokens"), F.size(n).alias("n_numbers"), F.size(k).alias("n_dates"), F.length(e).alias("excerpt_chars"))


def unit_pages(spark, base) -> DataFrame:
    """Pointers per page number that their unit ids carry."""
    p = read(spark, base, "node_pointers", "source_cluster_id", "end_char").where("source_cluster_id IS NOT NULL")
    return p.groupBy(X.page_of_unit("source_cluster_id").alias("page")).agg(F.count(F.lit(1)).alias("n"), F.count_if(X.open_end("end_char") == -1).alias("n_open"))


def fuzzy_thresholds(spark, base) -> DataFrame:
    """Pointers per fuzzy threshold of their text."""
    p = read(spark, base, "node_pointers", "verbatim_text").where("verbatim_text IS NOT NULL")
    return p.groupBy(X.fuzzy_threshold(F.length("verbatim_text")).alias("threshold"), X.preserve_threshold(F.length("verbatim_text")).alias("preserve")).agg(F.count(F.lit(1)).alias("n"))


# older forms


def legacy_unit_ids(spark, base) -> DataFrame:
    """Pointers in the older form of unit ids, brought back to the current one."""
    u = read(spark, base, "text_clusters", "document_id", "pdf_page_num", "cluster_number").distinct().select(F.col("document_id").alias("collection_id"), F.col("pdf_page_num").alias("page_number"), "cluster_number", _unit_key().alias("unit_id"))
    p = read(spark, base, "node_pointers", "node_id", "ptr_ord", "source_cluster_id").where("source_cluster_id IS NOT NULL").distinct()
    old = p.select("node_id", "ptr_ord", F.substring_index("source_cluster_id", "|", 1).alias("collection_id"), F.regexp_replace(F.substring_index("source_cluster_id", "|", -1), "_t", "_c").alias("source_cluster_id"))
    return legacy.canonical_pointers(old, legacy.legacy_aliases(u)).select("node_id", "ptr_ord", "source_cluster_id")


def legacy_units(spark, base) -> DataFrame:
    """Units by position, both lists."""
    return legacy.legacy_units(read(spark, base, "split_pages", "document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects")).select("document_id", "unit_id", "kind")


def mention_pointers(spark, base) -> DataFrame:
    """Exported spans read back as pointers."""
    p = read(spark, base, "node_pointers").distinct().where("start_char IS NOT NULL AND end_char IS NOT NULL")
    return legacy.pointers_of_mentions(graph.graph_nodes(_tree(spark, base), p)).select("node_id", "ptr_ord", "source_cluster_id", "start_char", "end_char")


def flags_as_words(spark, base) -> DataFrame:
    """Page flags as words, counted."""
    f = legacy.booleans_as_words(read(spark, base, "split_pages", "page_id", "contains_table", "incomplete_text").distinct())
    return f.groupBy("contains_table", "incomplete_text").agg(F.count(F.lit(1)).alias("n"))


def legacy_ladder(spark, base) -> DataFrame:
    """How many pointers each rung of the older ladder anchors."""
    p = read(spark, base, "node_pointers").distinct()
    return legacy.ladder(p, _cluster_units(spark, base)).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


#: What isn't a query of its own.
_NOT = {"flagship", "read", "cut", "queries"}


def queries():
    out = {k: v for k, v in globals().items() if callable(v) and not k.startswith("_") and k not in _NOT and getattr(v, "__module__", "") == __name__}
    return out | {"source_summary": flagship}
