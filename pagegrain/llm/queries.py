"""Named queries of this subpackage: (session, folder of tables) to DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import read_table as read
from . import leakage, mixing, mojibake, near_duplicates, repetition, scan_noise, truncation


def p1_found(spark, base):
    """Clusters whose text was cut short."""
    return truncation.truncated(read(spark, base, "text_clusters")).select("cluster_uid")


def p1_report(spark, base):
    """Per source how often texts are cut, beside what their pages claim."""
    clusters = read(spark, base, "text_clusters")
    return truncation.truncation_report(clusters, truncation.truncated(clusters), read(spark, base, "split_pages", "page_id", "incomplete_text"))


def p4_found(spark, base):
    """Clusters of at least 12 words of which at least 0.3 are repeated."""
    return repetition.repeating_texts(read(spark, base, "text_clusters", "cluster_uid", "text"), "cluster_uid")


def p4_shares(spark, base):
    """The repeated share of every cluster."""
    rep = repetition.repetition(read(spark, base, "text_clusters", "cluster_uid", "text"))
    return rep.where("n_words > 0").select("cluster_uid", "n_words", "n_repeated", F.round("repeated_share", 9).alias("repeated_share")).distinct()


def p4_fertility(spark, base):
    """Texts outside the fertility band of their script."""
    measured = repetition.fertility(read(spark, base, "text_clusters", "cluster_uid", "text").withColumn("script", repetition.script_of()))
    bands = repetition.fertility_bands(measured, "script")
    out = (F.col("chars_per_token") < F.col("min_chars")) | (F.col("chars_per_token") > F.col("max_chars")) | (F.col("token_entropy") < F.col("min_entropy")) | (F.col("byte_share") > F.col("max_bytes"))
    return measured.where("n_tokens >= 16").join(bands.drop("n"), "script").where(out).select("cluster_uid", "script", "n_tokens", "chars_per_token", "byte_share", "token_entropy").distinct()


def p5_found(spark, base):
    """Kinds of scan noise in clusters and boxes."""
    return scan_noise.noise(read(spark, base, "text_clusters"), read(spark, base, "raw_ocr_responses"))


def p5_repaired(spark, base):
    """Every text with its lines joined, words repaired and page furniture empty."""
    return scan_noise.repaired(read(spark, base, "text_clusters"), read(spark, base, "raw_ocr_responses"))


def p5_paragraphs(spark, base):
    """The repaired texts as the paragraphs of their documents, across texts and pages."""
    return scan_noise.paragraphs(p5_repaired(spark, base))


def _records(spark, base):
    return read(spark, base, "text_clusters", "cluster_uid", "text"), read(spark, base, "nodes", "id", "file_path"), read(spark, base, "page_hashes", "node_id", "page_hash")


def p7_found(spark, base):
    """Pairs of records that are nearly the same."""
    return near_duplicates.near_duplicate_records(*_records(spark, base))


def p7_groups(spark, base):
    """One row per record with its group of near-duplicates and its number of links."""
    out = None
    for kind, t in near_duplicates.KINDS.items():
        sets = near_duplicates.record_sets(kind, *_records(spark, base))
        part = near_duplicates.similarity_groups(sets, t).select(F.lit(kind).alias("record_kind"), "id", "group_id", "n_links")
        out = part if out is None else out.unionByName(part)
    return out


def p8_found(spark, base):
    """Documents that hold ten consecutive words of an item."""
    return leakage.leaked(read(spark, base, "documents"), read(spark, base, "eval_items"), k=10, coverage=1.0).select("doc_id", "item_id").distinct()


def p8_coverage(spark, base):
    """How much of each item a document holds, in any order: ten words in a row, or 0.8 of the item in pieces of five and more."""
    return leakage.leaked(read(spark, base, "documents"), read(spark, base, "eval_items"))


def p8_report(spark, base):
    """Per item the number of documents that hold it."""
    items = read(spark, base, "eval_items")
    return leakage.leak_report(leakage.leaked(read(spark, base, "documents"), items), items)


def _mix(spark, base):
    return mixing.mix(mixing.token_sizes(read(spark, base, "documents")), read(spark, base, "mix_targets"))


def p9_mix(spark, base):
    """The drawn documents by shard and position."""
    return _mix(spark, base)


def p9_shares(spark, base):
    """The shares reached."""
    return mixing.mix_shares(_mix(spark, base), read(spark, base, "mix_targets"))


def p9_within(spark, base):
    """Per target: is the source drawn at all, is its share within a hundredth of the target among the sources drawn, and is no document used too often?"""
    r = mixing.mix_shares(_mix(spark, base), read(spark, base, "mix_targets")).withColumn("drawn", F.col("n_tokens") > 0)
    whole = r.where("drawn").agg(F.sum("target_share").alias("whole"))
    ok = F.abs(F.col("reached_share") - F.when(F.col("drawn"), F.col("target_share") / F.col("whole")).otherwise(0.0)) <= 0.01
    return r.join(F.broadcast(whole)).select("source", "drawn", ok.alias("share_ok"), (F.col("most_uses") <= F.col("max_repeats")).alias("uses_ok"))  # one row


def p10_found(spark, base):
    """Documents with wrongly decoded text."""
    return mojibake.garbled_documents(read(spark, base, "documents"))


def p10_restored(spark, base):
    """Their restored text."""
    return mojibake.restored(read(spark, base, "documents"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("p") and k[1].isdigit()}
