"""Processing state as an append-only log of attempts, and what follows from it.

State is never updated in place: the latest attempt per key is the state, a changed input fingerprint drops a document's
rows, and skipping is a join of the plan with the completed rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["document_id", "page_number", "stage"]


def fingerprint(pages: DataFrame, key: str = "document_id", digest: str = "content_hash") -> DataFrame:
    """(key, input_fingerprint): sha256 over the sorted JSON of the page digests, the same in whatever order they come."""
    rows = F.array_sort(F.collect_list(F.struct("page_number", F.coalesce(digest, F.lit("")).alias("digest"))))
    return pages.groupBy(key).agg(F.sha2(F.to_json(rows), 256).alias("input_fingerprint"))


def ensure_documents(state: DataFrame, current: DataFrame) -> DataFrame:
    """State rows of documents whose fingerprint is unchanged; all rows of the others are gone."""
    return state.join(current.select("document_id", "input_fingerprint"), ["document_id", "input_fingerprint"], "left_semi")


def numbered_attempts(log: DataFrame, order: list[str]) -> DataFrame:
    """Adds attempt_index, from 1 in time order per key."""
    return log.withColumn("attempt_index", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)))


def latest(log: DataFrame, order: str) -> DataFrame:
    """One row per key: attempts so far and the last status, model, hash and error."""
    cols = [c for c in ("status", "model_name", "content_hash", "artifact_path", "error_message") if c in log.columns]
    return log.groupBy(*KEY).agg(F.count(F.lit(1)).alias("attempt_count"), F.max_by(F.struct(*cols), order).alias("_l")).select(*KEY, "attempt_count", *[F.col(f"_l.{c}").alias(c) for c in cols])


def to_do(plan: DataFrame, state: DataFrame) -> DataFrame:
    """The plan with skip: completed, of the same content, and with an artifact."""
    s = state.select(*KEY, F.col("status").alias("_s"), F.col("content_hash").alias("_h"), F.col("artifact_path").alias("_a"))
    ok = (F.col("_s") == "completed") & F.col("_h").eqNullSafe(F.col("content_hash")) & F.col("_a").isNotNull()
    return plan.join(s, KEY, "left").withColumn("skip", F.coalesce(ok, F.lit(False))).drop("_s", "_h", "_a")


def completion(state: DataFrame, total: DataFrame) -> DataFrame:
    """(document_id, total_pages, completed, is_completed): done when there are pages and all of them are completed."""
    c = state.groupBy("document_id").agg(F.count_if(F.col("status") == "completed").alias("completed"))
    t = total.select("document_id", "total_pages").join(c, "document_id", "left").withColumn("completed", F.coalesce("completed", F.lit(0)))
    return t.withColumn("is_completed", (F.col("total_pages") > 0) & (F.col("completed") == F.col("total_pages")))


def rebuild(artifacts: DataFrame, progress: DataFrame, images: DataFrame) -> DataFrame:
    """State from what lies on disk: pages with an artifact are completed; the hash comes from progress, else from the image."""
    j = artifacts.join(progress.select("document_id", "page_number", F.col("content_hash").alias("_p")), ["document_id", "page_number"], "left").join(images.select("document_id", "page_number", F.col("content_hash").alias("_i")), ["document_id", "page_number"], "left")
    return j.select("document_id", "page_number", F.lit("completed").alias("status"), F.coalesce("_p", "_i").alias("content_hash"), "artifact_path")


def first_success(attempts: DataFrame) -> DataFrame:
    """Per page the first candidate model that succeeded, and how many failed before it; none where all failed."""
    ok = F.when(F.col("status") == "completed", F.col("candidate"))
    g = attempts.groupBy("document_id", "page_number").agg(F.min(ok).alias("_first"), F.min_by("model_name", ok).alias("model_name"), F.count(F.lit(1)).alias("n_tried"))
    return g.select("document_id", "page_number", "model_name", F.coalesce("_first", "n_tried").alias("n_failed"), F.col("_first").isNotNull().alias("succeeded"))


def run_ladder(pages: DataFrame, models: list[str], hook: Callable, ok: Callable) -> DataFrame:
    """Try models in order; each round only sees the pages that failed before. ``hook(pages, model)`` adds columns, ``ok`` is a condition."""
    out, rest = None, pages
    for i, m in enumerate(models):
        got = hook(rest, m).withColumns({"model_name": F.lit(m), "candidate": F.lit(i), "status": F.when(ok(), "completed").otherwise("failed")})
        out = got if out is None else out.unionByName(got)
        rest = got.where("status = 'failed'").select(*pages.columns)
    return out


def progress_export(state: DataFrame, stage: str = "ocr") -> DataFrame:
    """(document_id, page_number, image_sha256, json_path, status) of a stage's pages that have an artifact; a null hash is empty."""
    rows = state.where((F.col("stage") == stage) & F.col("artifact_path").isNotNull())
    return rows.select("document_id", "page_number", F.coalesce("content_hash", F.lit("")).alias("image_sha256"), F.col("artifact_path").alias("json_path"), "status")
