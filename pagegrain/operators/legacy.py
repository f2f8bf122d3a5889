"""Forms of an older generation of data, read into the current one, and small helpers on nested values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..session import cut
from .grounding import fuzzy_ground, ground

LEGACY_UNIT = r"^p\d+_c\d+$"


def legacy_aliases(units: DataFrame) -> DataFrame:
    """(collection_id, alias, unit_id): p<page>_c<number> for every unit; of several the first by unit id wins."""
    alias = F.format_string("p%d_c%d", "page_number", "cluster_number")
    return units.groupBy("collection_id", alias.alias("alias")).agg(F.min("unit_id").alias("unit_id"))


def canonical_pointers(pointers: DataFrame, aliases: DataFrame) -> DataFrame:
    """Pointers with legacy unit ids replaced through the aliases of their collection; other and unknown ids stay."""
    a = aliases.select("collection_id", F.col("alias").alias("_a"), F.col("unit_id").alias("_u"))
    legacy = F.col("source_cluster_id").rlike(LEGACY_UNIT)
    j = pointers.join(a, (pointers["collection_id"] == a["collection_id"]) & (F.col("source_cluster_id") == F.col("_a")) & legacy, "left").drop(a["collection_id"])
    return j.withColumn("source_cluster_id", F.coalesce("_u", "source_cluster_id")).drop("_a", "_u")


def legacy_units(pages: DataFrame) -> DataFrame:
    """(document_id, unit_id, kind, text) by position in the page's two lists: p<page>_c<i>; both are kept where ids meet, told apart by kind."""
    t = pages.select("document_id", "pdf_page_num", F.posexplode("OCR_text_clusters").alias("i", "o")).select("document_id", "pdf_page_num", "i", F.lit("text").alias("kind"), F.col("o.text").alias("text"))
    o = pages.select("document_id", "pdf_page_num", F.posexplode("non_text_objects").alias("i", "o")).select("document_id", "pdf_page_num", "i", F.lit("object").alias("kind"), F.col("o.description").alias("text"))
    return t.unionByName(o).select("document_id", F.format_string("p%d_c%d", "pdf_page_num", "i").alias("unit_id"), "kind", "text").distinct()


def collide(units: DataFrame, prefer: str = "object") -> DataFrame:
    """One text per id, as the older generation had it: objects overwrite texts."""
    w = Window.partitionBy("document_id", "unit_id").orderBy((F.col("kind") != prefer).cast("int"), "kind", "text")
    return units.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def concat_lists(a: Column | str, b: Column | str) -> Column:
    """Both lists one after the other; null only if both are."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a.isNull() & b.isNull(), None).otherwise(F.concat(F.coalesce(a, F.filter(b, lambda x: F.lit(False))), F.coalesce(b, F.filter(a, lambda x: F.lit(False)))))


def booleans_as_words(df: DataFrame, yes: str = "Yes", no: str = "No") -> DataFrame:
    """Every boolean, at any depth of structs, lists and maps, as a word; null stays null."""

    def turn(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.BooleanType):
            return F.when(c, yes).when(~c, no)
        if isinstance(t, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[turn(c[f.name], f.dataType).alias(f.name) for f in t]))
        if isinstance(t, T.ArrayType):
            return F.transform(c, lambda x: turn(x, t.elementType))
        if isinstance(t, T.MapType):
            return F.transform_values(c, lambda k, v: turn(v, t.valueType))
        return c

    return df.select(*[turn(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


def page_of_response(df: DataFrame, text: str = "response_json") -> DataFrame:
    """Adds clusters: those of a structured answer; where it isn't one, its raw text as a single cluster that fills the page."""
    shape = "struct<OCR_text_clusters:array<struct<text:string,cluster_number:int>>>"
    parsed = F.from_json(F.col(text), shape)["OCR_text_clusters"]
    whole = F.array(F.struct(F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(0).alias("cluster_number")))
    return df.withColumn("clusters", F.coalesce(parsed, whole))


def pointers_of_mentions(gnodes: DataFrame) -> DataFrame:
    """(node_id, ptr_ord, source_cluster_id, start_char, end_char, verbatim_text): exported spans back as pointers with inclusive ends.

    The blank span of a node without pointers is none.
    """
    s = gnodes.select(F.col("id").alias("node_id"), F.explode("mentions").alias("s"))
    s = s.where("s.source_cluster_id IS NOT NULL")
    return s.select("node_id", F.col("s.ptr_ord").alias("ptr_ord"), F.col("s.source_cluster_id").alias("source_cluster_id"), F.col("s.start_char").alias("start_char"), (F.col("s.end_exclusive") - 1).alias("end_char"), F.col("s.excerpt").alias("verbatim_text"))


def unescaped(c: Column | str) -> Column:
    """A text that was stored as a quoted literal, without its quotes and common escapes; other texts as they are."""
    c = F.col(c) if isinstance(c, str) else c
    inner = F.regexp_extract(c, r"(?s)^\s*(?:'''|\"\"\"|'|\")(.*?)(?:'''|\"\"\"|'|\")\s*$", 1)
    plain = F.replace(F.replace(F.replace(F.replace(inner, F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit("\\'"), F.lit("'")), F.lit('\\"'), F.lit('"'))
    return F.when(c.rlike(r"(?s)^\s*(['\"]).*\1\s*$"), plain).otherwise(c)


def same_page_first(lost: DataFrame, units: DataFrame) -> DataFrame:
    """Exact text of lost pointers sought in the units of their document: (node_id, ptr_ord, unit, start), their own unit first, then the same page, then by unit id.

    Units are joined by document; only pointers that nothing else anchors take part.
    """
    doc = lambda c: F.substring_index(c, "|", 1)
    p = lost.where("verbatim_text <> ''").select("node_id", "ptr_ord", "source_cluster_id", "verbatim_text", doc(F.col("source_cluster_id")).alias("_d"), X.page_of_unit("source_cluster_id").alias("_p"))
    u = units.where("text IS NOT NULL").select(F.col("source_cluster_id").alias("unit"), "text", doc(F.col("source_cluster_id")).alias("_d"), X.page_of_unit("source_cluster_id").alias("_q"))
    hit = p.join(u, "_d").where(F.contains("text", "verbatim_text"))
    order = F.struct((F.col("unit") != F.col("source_cluster_id")).alias("other"), (F.col("_p") != F.col("_q")).alias("far"), "unit")
    best = F.min_by(F.struct("unit", (F.instr(F.col("text"), F.col("verbatim_text")) - 1).alias("start")), order)
    return hit.groupBy("node_id", "ptr_ord", "verbatim_text").agg(best.alias("b")).select("node_id", "ptr_ord", F.col("b.unit").alias("unit"), F.col("b.start").alias("start"))


def ladder(pointers: DataFrame, units: DataFrame) -> DataFrame:
    """(node_id, ptr_ord, tier, unit, start_char, end_char): every pointer by the first way that anchors it.

    The span as it is, or an exact text in its unit; then its collapsed or nearly equal text there; then its exact text in
    another unit of the page, or of the document. What nothing anchors is lost and has no unit.
    """
    g = cut(ground(pointers, units))
    key = ["node_id", "ptr_ord", "verbatim_text"]
    lost = g.where(F.col("tier").isin("lost", "unknown"))
    exact = g.where(~F.col("tier").isin("lost", "unknown")).select("node_id", "ptr_ord", "tier", F.col("source_cluster_id").alias("unit"), F.col("new_start").alias("start_char"), F.col("new_end").alias("end_char"))
    near = cut(fuzzy_ground(lost, units))
    fuzzy = near.select("node_id", "ptr_ord", F.col("fuzzy_tier").alias("tier"), F.col("source_cluster_id").alias("unit"), F.col("fuzzy_start").alias("start_char"), F.col("fuzzy_end").alias("end_char"))
    rest = cut(lost.join(near.select("node_id", "ptr_ord"), ["node_id", "ptr_ord"], "left_anti"))
    there = same_page_first(rest, units).withColumnRenamed("start", "_s")
    last = rest.select(*key).join(there, ["node_id", "ptr_ord"], "left").select("node_id", "ptr_ord", F.when(F.col("unit").isNull(), "lost").otherwise("elsewhere").alias("tier"), "unit", F.col("_s").alias("start_char"), (F.col("_s") + F.length("verbatim_text") - 1).alias("end_char"))
    return exact.unionByName(fuzzy).unionByName(last)
