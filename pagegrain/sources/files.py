"""Files and folders as tables, and the append-only sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = (
    "pdf_page_num int, printed_page_number string, contains_table boolean, "
    "OCR_text_clusters array<struct<text:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>, "
    "non_text_objects array<struct<description:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>, "
    "is_empty_page boolean, meaningful_ordering array<int>, page_x_min double, page_x_max double, page_y_min double, page_y_max double, "
    "estimated_rotation_degrees double, incomplete_words_on_edge boolean, incomplete_text boolean, data_loss_likelihood double, scan_quality string, "
    "metadata struct<ocr_model_name:string,ocr_datetime:double,ocr_json_version:string>"
)


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, title, text, source_format): a row per text or Markdown file, the name as id."""
    t = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return t.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("document_id"), F.col("name").alias("title"), "text", F.when(F.lower("name").rlike(r"\.(md|markdown)$"), "markdown").otherwise("text").alias("source_format"))


def discover(spark: SparkSession, path: str, suffixes: list[str] | None = None, recursive: bool = True, content: bool = False) -> DataFrame:
    """(path, name, suffix, size, modified), distinct and ordered by path; suffixes are compared in lower case."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    out = f.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("suffix"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *(["content"] if content else []))
    out = out.where(F.col("suffix").isin([s.lower() for s in suffixes])) if suffixes else out
    return out.dropDuplicates(["path"]).orderBy("path")


def page_folder(spark: SparkSession, path: str) -> DataFrame:
    """Page JSON files named page_N.json, with document (the folder) and page (N), in numeric order."""
    p = spark.read.schema(PAGE_SCHEMA).json(path, multiLine=True, recursiveFileLookup=True).withColumn("_f", F.col("_metadata.file_path"))
    n = F.regexp_extract("_f", r"page_(\d+)\.json$", 1)
    return p.where(n != "").withColumns({"document_id": F.element_at(F.split("_f", "/"), -2), "page_number": n.cast("int")}).drop("_f").orderBy("document_id", "page_number")


def filter_files(files: DataFrame, allow: DataFrame | None = None, pattern: str | None = None, after: str | None = None, before: str | None = None, most: int | None = None) -> DataFrame:
    """Adds reason: why a file is left out, null where it passes. Time bounds are strict; ``allow`` has exact paths or names.

    ``most`` keeps the first so many passing files in path order.
    """
    stamp = lambda s: F.to_timestamp(F.lit(s), "yyyy-MM-dd HH:mm")
    ok: list[tuple[Column, str]] = []
    f = files
    if allow is not None:
        f = f.join(allow.select(F.col("path").alias("name"), F.lit(True).alias("_a")).distinct(), "name", "left")
        ok.append((F.coalesce("_a", F.lit(False)), "not allowed"))
    if pattern:
        ok.append((F.col("path").rlike(pattern), "pattern"))
    if after:
        ok.append((F.col("modified") > stamp(after), "too old"))
    if before:
        ok.append((F.col("modified") < stamp(before), "too new"))
    reason = F.lit(None).cast("string")
    for c, why in reversed(ok):
        reason = F.when(~c, why).otherwise(reason)
    f = f.withColumn("reason", reason).drop("_a")
    if most is None:
        return f
    kept = f.where("reason IS NULL").orderBy("path").limit(most).select("path", F.lit(True).alias("_k"))
    return f.join(kept, "path", "left").withColumn("reason", F.when(F.col("reason").isNull() & F.col("_k").isNull(), "over the maximum").otherwise(F.col("reason"))).drop("_k")


def reject_reasons(filtered: DataFrame) -> DataFrame:
    return filtered.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def uniform_folders(files: DataFrame, level: int) -> DataFrame:
    """(folder): ancestors whose every file lies exactly ``level`` folders below."""
    parts = F.split("path", "/")
    a = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), "/").alias("folder"), (F.size(parts) - 1 - k).alias("below")))).alias("x"))
    return a.groupBy("x.folder").agg(F.min("x.below").alias("lo"), F.max("x.below").alias("hi")).where((F.col("lo") == level) & (F.col("hi") == level)).select("folder")


def folders_by_count(files: DataFrame, more_than: int, fewer_than: int, first: int | None = None) -> DataFrame:
    """(folder, n_files) with a count strictly between the bounds, in order, the first so many."""
    g = files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.count(F.lit(1)).alias("n_files"))
    g = g.where((F.col("n_files") > more_than) & (F.col("n_files") < fewer_than)).orderBy("folder")
    return g.limit(first) if first is not None else g


def append_json(df: DataFrame, path: str) -> None:
    """One JSON line per row, appended."""
    df.write.mode("append").json(path)


def append_log(df: DataFrame, path: str, *partition: str) -> None:
    """Append rows to a parquet log."""
    df.write.mode("append").partitionBy(*partition).parquet(path)
