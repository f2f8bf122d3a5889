"""Source units: text, page and OCR inputs in one shape, with stable ids and validity rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

TEXT_KINDS = ("text", "ocr_text")


def text_units(documents: DataFrame) -> DataFrame:
    """One unit a document: page 1, cluster 0. Null texts give units with null text."""
    return documents.select(
        F.col("doc_id").cast("string").alias("collection_id"), F.lit(1).alias("page_number"), F.lit(0).alias("cluster_number"), F.lit("text").alias("modality"), "text", F.lit(None).cast("string").alias("description"), F.lit("default_text").alias("embedding_space")
    )


def wrap_text(df: DataFrame, text: str = "text") -> DataFrame:
    """A raw text as one OCR cluster that fills a page of 0 to 1000."""
    box = [F.lit(0.0).alias("bb_x_min"), F.lit(1000.0).alias("bb_x_max"), F.lit(0.0).alias("bb_y_min"), F.lit(1000.0).alias("bb_y_max")]
    return df.withColumn("OCR_text_clusters", F.array(F.struct(F.col(text).alias("text"), *box, F.lit(0).alias("cluster_number"))))


def ocr_units(pages: DataFrame) -> DataFrame:
    """Text clusters and non-text objects of OCR pages as units; repeated pages count once."""
    p = pages.select("document_id", "pdf_page_num", "OCR_text_clusters", "non_text_objects").distinct()
    t = p.select("document_id", "pdf_page_num", F.explode("OCR_text_clusters").alias("o")).select(
        F.col("document_id").alias("collection_id"), F.col("pdf_page_num").alias("page_number"), F.col("o.cluster_number").alias("cluster_number"), F.lit("ocr_text").alias("modality"), F.col("o.text").alias("text"), F.lit(None).cast("string").alias("description"), F.lit("default_text").alias("embedding_space")
    )
    i = p.select("document_id", "pdf_page_num", F.explode("non_text_objects").alias("o")).select(
        F.col("document_id").alias("collection_id"), F.col("pdf_page_num").alias("page_number"), F.col("o.cluster_number").alias("cluster_number"), F.lit("image_region").alias("modality"), F.lit(None).cast("string").alias("text"), F.col("o.description").alias("description"), F.lit("image").alias("embedding_space")
    )
    return t.unionByName(i)


def with_unit_ids(units: DataFrame, order: list[str]) -> DataFrame:
    """Adds unit_id: the given one, else collection|p<page>_<t or i><cluster number, else ordinal>.

    The ordinal counts the earlier units of the same class on the page, in ``order``.
    """
    kind = F.when(F.col("modality").isin(*TEXT_KINDS), "t").otherwise("i")
    w = Window.partitionBy("collection_id", "page_number", kind).orderBy(*order)
    number = F.coalesce(F.col("cluster_number"), F.row_number().over(w) - 1)
    derived = F.concat(F.col("collection_id"), F.lit("|p"), F.coalesce("page_number", F.lit(1)).cast("string"), F.lit("_"), kind, number.cast("string"))
    own = F.col("unit_id") if "unit_id" in units.columns else F.lit(None).cast("string")
    return units.withColumn("unit_id", F.coalesce(own, derived))


def collisions(units: DataFrame) -> DataFrame:
    """(unit_id, n) of the ids that several units have."""
    return units.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(units: DataFrame) -> DataFrame:
    """The units; the plan fails when an id comes twice."""
    w = Window.partitionBy("unit_id")
    checked = units.withColumn("_n", F.count(F.lit(1)).over(w))
    return checked.withColumn("unit_id", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate unit id "), "unit_id"))).otherwise(F.col("unit_id"))).drop("_n")


def records(units: DataFrame) -> DataFrame:
    """Grounded records: text or description or nothing, the parser's text, and whether the unit takes part in the text."""
    hint = F.col("parser_hint_text") if "parser_hint_text" in units.columns else F.lit(None).cast("string")
    return units.withColumns({"parser_text": X.first_nonempty(hint, "text", "description"), "text": X.first_nonempty("text", "description"), "in_text": F.col("modality").isin(*TEXT_KINDS)})


MODES = {
    "llm": ("unit_id", "page_number", "modality", "parser_text"),
    "frontend": ("unit_id", "collection_id", "page_number", "cluster_number", "modality", "text"),
    "dto": ("unit_id", "collection_id", "page_number", "cluster_number", "modality", "text", "parser_text"),
    "backend": ("unit_id", "collection_id", "page_number", "cluster_number", "modality", "text", "parser_text", "embedding_space", "in_text"),
}


def view(recs: DataFrame, mode: str) -> DataFrame:
    """The columns that a mode may see."""
    return recs.select(*MODES[mode])


def quarantine(units: DataFrame) -> DataFrame:
    """Adds valid: texts need text, other units a description or an address."""
    t, d = X.first_nonempty("text"), X.first_nonempty("description")
    u = X.first_nonempty("source_uri") if "source_uri" in units.columns else F.lit("")
    return units.withColumn("valid", F.when(F.col("modality").isin(*TEXT_KINDS), t != "").otherwise((t != "") | (d != "") | (u != "")))


def page_checks(pages: DataFrame) -> DataFrame:
    """Per distinct page: emptiness agrees with its lists, numbers are distinct over both lists, the order has no repeats.

    Null lists count as empty and a null flag as false.
    """
    none = F.array().cast("array<int>")
    t, o = F.coalesce(F.col("OCR_text_clusters.cluster_number"), none), F.coalesce(F.col("non_text_objects.cluster_number"), none)
    m = F.coalesce("meaningful_ordering", none)
    return pages.select("page_id", "OCR_text_clusters", "non_text_objects", "meaningful_ordering", "is_empty_page").distinct().select(
        "page_id",
        (F.coalesce("is_empty_page", F.lit(False)) == (F.size(t) + F.size(o) == 0)).alias("empty_ok"),
        (~F.arrays_overlap(t, o) & (F.size(F.array_distinct(t)) == F.size(t)) & (F.size(F.array_distinct(o)) == F.size(o))).alias("ids_ok"),
        (F.size(F.array_distinct(m)) == F.size(m)).alias("order_ok"),
    )


def page_text(pages: DataFrame, rest: bool = True) -> DataFrame:
    """(page_id, text): clusters joined by line ends in their meaningful order; with ``rest`` the ones it leaves out follow by number."""
    p = pages.select("page_id", "OCR_text_clusters", "meaningful_ordering").distinct()
    e = p.select("page_id", "meaningful_ordering", F.explode("OCR_text_clusters").alias("o"))
    at = F.coalesce(F.array_position(F.coalesce("meaningful_ordering", F.array().cast("array<int>")), F.col("o.cluster_number")), F.lit(0))
    e = e.select("page_id", at.alias("at"), F.col("o.cluster_number").alias("number"), F.coalesce("o.text", F.lit("")).alias("t"))
    if not rest:
        e = e.where("at > 0")
    parts = e.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct((F.col("at") == 0).alias("late"), "at", "number", "t"))).alias("l"))
    return parts.select("page_id", F.array_join(F.col("l.t"), "\n").alias("text"))


def named_boxes(df: DataFrame, box: str = "box_2d") -> DataFrame:
    """[y_min, x_min, y_max, x_max] as named columns."""
    return df.withColumns({n: F.col(box)[i].cast("double") for i, n in enumerate(("bb_y_min", "bb_x_min", "bb_y_max", "bb_x_max"))})


def parser_input(pages: DataFrame) -> DataFrame:
    """(document_id, pdf_page_num, printed_page_number, contains_table, texts, objects): pages as the parser reads them.

    Units without a number get their place on the page, texts first; objects say description, else address, else image-region.
    """
    n = F.coalesce(F.size("OCR_text_clusters"), F.lit(0))
    text = F.transform("OCR_text_clusters", lambda o, i: F.struct(F.coalesce(o["text"], F.lit("")).alias("text"), F.coalesce(o["cluster_number"], i).alias("cluster_number")))
    thing = F.transform("non_text_objects", lambda o, i: F.struct(F.coalesce(F.nullif(o["description"], F.lit("")), F.lit("image-region")).alias("description"), F.coalesce(o["cluster_number"], i + n).alias("cluster_number")))
    cols = ["document_id", "pdf_page_num", "printed_page_number", F.coalesce("contains_table", F.lit(False)).alias("contains_table")]
    return pages.select(*cols, F.coalesce(text, F.array().cast("array<struct<text:string,cluster_number:int>>")).alias("texts"), F.coalesce(thing, F.array().cast("array<struct<description:string,cluster_number:int>>")).alias("objects")).distinct()


def primary(collections: DataFrame, order: str) -> DataFrame:
    """The first collection, as one row."""
    return collections.orderBy(order).limit(1)


def embedding_spaces(units: DataFrame) -> DataFrame:
    """(collection_id, spaces): the default space of every collection, and image where one of its units is one."""
    g = units.groupBy("collection_id").agg(F.bool_or(F.col("modality") == "image_region").alias("_i"))
    return g.select("collection_id", F.when(F.col("_i"), F.array(F.lit("default_text"), F.lit("image"))).otherwise(F.array(F.lit("default_text"))).alias("spaces"))


def response_checks(objects: DataFrame) -> DataFrame:
    """(record_id, ids_ok): no number comes twice among a response's text boxes and objects; ``objects`` are those of ``nested.json_objects``."""
    return objects.groupBy("record_id").agg((F.count(F.lit(1)) == F.countDistinct("object_id")).alias("ids_ok"))


def refine_wanted(pages: DataFrame, least: int = 5) -> DataFrame:
    """(page_id, wanted): pages with a table and enough clusters that no refined version was made of yet."""
    n = F.coalesce(F.size("OCR_text_clusters"), F.lit(0))
    return pages.select("page_id", (F.col("refined_version").isNull() & F.coalesce("contains_table", F.lit(False)) & (n >= least)).alias("wanted")).distinct()


def text_kept(before: list[str | None], after: list[str | None]) -> bool:
    """Does the refined text hold every cluster's text, nearly, as its length asks? Blank clusters don't count."""
    from .grounding import partial_ratio

    whole = " ".join(x or "" for x in after)
    need = lambda n: 100 if n < 30 else 98 if n < 60 else 95
    return all(b in whole or partial_ratio(b, whole) >= need(len(b)) for b in (x or "" for x in before) if b.strip())


def refine_gate(pages: DataFrame) -> DataFrame:
    """(page_id, preserved) of the pages with a refined version: is no text of the clusters lost in it?"""

    @F.pandas_udf("boolean")
    def kept(before, after):
        import pandas as pd

        return pd.Series([text_kept(list(b if b is not None else []), list(a if a is not None else [])) for b, a in zip(before, after)])

    rows = pages.where("refined_version IS NOT NULL").select("page_id", F.col("OCR_text_clusters.text").alias("_b"), F.col("refined_version.OCR_text_clusters.text").alias("_a")).distinct()
    return rows.select("page_id", kept("_b", "_a").alias("preserved"))


def image_payloads(df: DataFrame) -> DataFrame:
    """Adds file_name and content: what is to be stored for each page image; rows are (page_number, image_path, image_bytes_b64, filename).

    An image with a path keeps its suffix and is read from there later (content is null); one with content is decoded; one with
    neither fails. Pages without a number can't be told apart and fail too.
    """
    path, b64 = F.nullif("image_path", F.lit("")), F.nullif("image_bytes_b64", F.lit(""))
    suffix = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    page = F.concat(F.lit("page_"), F.coalesce(F.col("page_number").cast("string"), F.raise_error(F.lit("an image without a page number"))))
    name = F.when(path.isNotNull(), F.concat(page, F.coalesce(F.nullif(suffix, F.lit("")), F.lit(".png")))).when(b64.isNotNull(), F.coalesce("filename", F.concat(page, F.lit(".png")))).otherwise(F.raise_error(F.lit("an image needs a path or its content")))
    return df.withColumns({"file_name": name, "content": F.when(path.isNull(), F.unbase64(b64))})


def rasterised(files: DataFrame, hook, schema: str = "path string, page_number int, content binary") -> DataFrame:
    """Page images of files (path, content) by ``hook``, which gets and gives pandas batches: there is no PDF reader here."""
    return files.select("path", "content").mapInPandas(lambda parts: (hook(p) for p in parts), schema)
