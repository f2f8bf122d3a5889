"""Trees as graph payloads and back, sinks that only add what is missing, and waves from the leaves up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .hierarchy import heights, links
from .numbering import numbered


def spans(pointers: DataFrame) -> DataFrame:
    """Pointers as exported spans: the end is exclusive, at least one position and the text's length behind the start."""
    size = F.greatest(F.length(F.coalesce("verbatim_text", F.lit(""))), F.lit(1))
    return pointers.select("node_id", "ptr_ord", "source_cluster_id", "start_char", F.greatest(F.col("end_char") + 1, F.col("start_char") + size).alias("end_exclusive"), F.coalesce("verbatim_text", F.lit("")).alias("excerpt"), F.lit(1).alias("page_number"))


def graph_nodes(nodes: DataFrame, pointers: DataFrame) -> DataFrame:
    """(id, label, type, summary, semantic_node_type, doc_id, parent_id, level_from_root, mentions); a node without pointers has one blank span [0, 1)."""
    s = spans(pointers).groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("ptr_ord", "source_cluster_id", "start_char", "end_exclusive", "excerpt"))).alias("mentions"))
    blank = F.array(F.struct(F.lit(0).alias("ptr_ord"), F.lit(None).cast("string").alias("source_cluster_id"), F.lit(0).alias("start_char"), F.lit(1).alias("end_exclusive"), F.lit("").alias("excerpt")))
    n = nodes.join(s, "node_id", "left")
    return n.select(F.col("node_id").alias("id"), F.col("title").alias("label"), F.lit("entity").alias("type"), F.col("title").alias("summary"), F.col("node_type").alias("semantic_node_type"), F.col("document_id").alias("doc_id"), "parent_id", "level_from_root", F.coalesce("mentions", blank).alias("mentions"))


def graph_edges(nodes: DataFrame) -> DataFrame:
    """(id, relation, source_ids, target_ids, doc_id): one HAS_CHILD edge per node with a parent among the nodes."""
    n = nodes.select("node_id", "parent_id", "document_id").distinct()
    e = n.join(n.select(F.col("node_id").alias("parent_id")).distinct(), "parent_id", "left_semi")
    return e.select(X.stable_id("edge", "parent_id", "node_id").alias("id"), F.lit("HAS_CHILD").alias("relation"), F.array("parent_id").alias("source_ids"), F.array("node_id").alias("target_ids"), F.col("document_id").alias("doc_id"))


def tree_of(gnodes: DataFrame, gedges: DataFrame) -> DataFrame:
    """Back from a payload: (node_id, parent_id, node_type, title, level_from_root). Only HAS_CHILD edges count; parents come from edges."""
    e = gedges.where("relation = 'HAS_CHILD'").select(F.explode("source_ids").alias("parent_id"), "target_ids").select("parent_id", F.explode("target_ids").alias("node_id")).distinct()
    known = e.join(gnodes.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")
    return gnodes.select(F.col("id").alias("node_id"), F.col("semantic_node_type").alias("node_type"), F.col("label").alias("title"), "level_from_root").join(known, "node_id", "left").select("node_id", "parent_id", "node_type", "title", "level_from_root")


def with_temp_ids(ids: DataFrame, prefix: str) -> DataFrame:
    """(id, temp_id): prefix:1, prefix:2 ... in the order of the ids.

    Numbers come from a range partition's own count plus the counts before it, so no task holds all ids.
    """
    n = numbered(ids.select("id").distinct(), "id", "_n")
    return n.select("id", F.concat(F.lit(f"{prefix}:"), (F.col("_n") + 1).cast("string")).alias("temp_id"))


def rewrite_edges(gedges: DataFrame, temp: DataFrame) -> DataFrame:
    """Edge endpoints by temporary ids; unknown ones stay."""
    t = temp.select(F.col("id").alias("_id"), "temp_id")
    one = gedges.select("id", F.posexplode(F.concat(F.transform("source_ids", lambda x: F.struct(F.lit("s").alias("side"), x.alias("end"))), F.transform("target_ids", lambda x: F.struct(F.lit("t").alias("side"), x.alias("end"))))).alias("at", "e"))
    got = one.join(t, F.col("e.end") == F.col("_id"), "left").select("id", "at", F.col("e.side").alias("side"), F.coalesce("temp_id", F.col("e.end")).alias("end"))
    pick = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("at", "end")))), lambda x: x["end"])
    return got.groupBy("id").agg(pick("s").alias("source_ids"), pick("t").alias("target_ids"))


def insert_if_absent(target: DataFrame, new: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """The rows of ``new`` that the target lacks; of repeated ids the first by ``order``, without one the smallest row."""
    rest = [F.col(c) for c in new.columns if c != key]
    by = F.struct(*([F.col(order)] if order else []), *rest)
    one = new.groupBy(key).agg(F.min(F.struct(by.alias("by"), F.struct(*rest).alias("row")) if rest else F.lit(0)).alias("_b"))
    got = one.join(target.select(key), key, "left_anti")
    return got.select(key, *[F.col(f"_b.row.{c}").alias(c) for c in new.columns if c != key]).select(*new.columns)


def edge_spans(gedges: DataFrame, gnodes: DataFrame) -> DataFrame:
    """Edges with mentions: the child's spans, or the parent's where the child has none but the blank one."""
    own = gnodes.select("id", F.filter("mentions", lambda m: m["source_cluster_id"].isNotNull()).alias("_m"))
    child, parent = own.select(F.col("id").alias("_c"), F.col("_m").alias("_mc")), own.select(F.col("id").alias("_p"), F.col("_m").alias("_mp"))
    j = gedges.join(child, F.col("target_ids")[0] == F.col("_c"), "left").join(parent, F.col("source_ids")[0] == F.col("_p"), "left")
    return j.withColumn("mentions", F.when(F.size("_mc") > 0, F.col("_mc")).otherwise(F.col("_mp"))).select(*gedges.columns, "mentions")


def legacy_graph(nodes: DataFrame, pointers: DataFrame, method: str = "semantic_document_parser_v1") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) in the older form: inclusive ends, pages read from unit ids, texts in the summary (4,000 characters of them), parents' spans on the edges.

    (id, label, summary, semantic_node_type, doc_id, kind, mentions) and (id, summary, source_id, target_id, mentions).
    """
    page = X.page_of_unit("source_cluster_id")
    span = F.struct("ptr_ord", "source_cluster_id", page.alias("page_number"), "start_char", "end_char", F.coalesce("verbatim_text", F.lit("")).alias("excerpt"))
    m = pointers.groupBy("node_id").agg(F.array_sort(F.collect_list(span)).alias("mentions"))
    said = F.substring(F.array_join(F.col("mentions.excerpt"), "\n"), 1, 4000)
    n = nodes.join(m, "node_id", "left")
    none = F.col("parent_id").isNull() | (F.col("parent_id") == "")
    out = n.select(F.col("node_id").alias("id"), F.col("title").alias("label"), F.concat("title", F.lit(":\n"), F.coalesce(said, F.lit(""))).alias("summary"), F.col("node_type").alias("semantic_node_type"), F.col("document_id").alias("doc_id"), F.when(none, "document_root").alias("kind"), "mentions")
    e = graph_edges(nodes).select(F.col("source_ids")[0].alias("source_id"), F.col("target_ids")[0].alias("target_id"), "doc_id")
    edge = e.join(m.select(F.col("node_id").alias("source_id"), "mentions"), "source_id", "left")
    return out, edge.select(X.stable_id("legacy-edge", F.lit("HAS_CHILD"), "source_id", "target_id", "doc_id", F.lit(method)).alias("id"), F.concat("source_id", F.lit(" -> "), "target_id", F.lit(" (HAS_CHILD)")).alias("summary"), "source_id", "target_id", "mentions")


def digest_waves(nodes: DataFrame) -> DataFrame:
    """(node_id, wave): 0 for leaves, else one more than the highest child; ids on loops have none."""
    return heights(links(nodes, "node_id", "parent_id")).select(F.col("id").alias("node_id"), F.col("height").cast("int").alias("wave"))


def digest_payload(nodes: DataFrame, verbatim: DataFrame) -> DataFrame:
    """Per node the cheaper of its own text and its children's titles, by token estimate: (node_id, payload_kind, tokens)."""
    own = nodes.select("node_id", "title").join(verbatim.select("node_id", F.col("text").alias("own")), "node_id", "left")
    kids = nodes.where("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("node_id")).agg(F.sum(X.token_estimate(F.substring(F.coalesce("title", F.lit("")), 1, 120))).alias("kids"))
    both = own.join(kids, "node_id", "left").withColumn("mine", X.token_estimate("own"))
    by_kids = F.col("kids").isNotNull() & (F.col("kids") < F.col("mine"))
    return both.select("node_id", F.when(by_kids, "children").otherwise("verbatim").alias("payload_kind"), F.when(by_kids, F.col("kids")).otherwise(F.col("mine")).alias("tokens"))


def export_bundle(gnodes: DataFrame, gedges: DataFrame, mode: str = "canonical") -> DataFrame:
    """One row per document: node and edge counts, node types and the mode."""
    n = gnodes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.countDistinct("semantic_node_type").alias("n_types"), F.max("level_from_root").alias("max_level"))
    e = gedges.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_edges"))
    return n.join(e, "doc_id", "left").select("doc_id", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"), "n_types", "max_level", F.lit(mode).alias("mode"))
