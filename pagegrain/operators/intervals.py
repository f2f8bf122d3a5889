"""Interval algebra over inclusive [start, end] spans of an entity, in two levels.

Spans are clipped to shards of ``width`` positions and merged inside (entity, shard); only coverage that touches
a shard boundary is stitched per entity afterwards. However many spans one entity has, a task of the first level
holds those of one shard, and the second level sees at most two rows a shard. Shards that a span fills are not
listed one by one but as blocks of doubling size. Spans with a null or reversed bound or a null key are nothing; repeated spans change nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

SHARD = 4096


def _pieces(df: DataFrame, keys: list[str], start: str, end: str, width: int) -> tuple[DataFrame, DataFrame | None]:
    """(keys, _k, _s, _e) and (keys, _l, _b, _s, _e): a span's pieces in its first and last shard, and the shards it fills between.

    Filled shards come as blocks of 2**_l shards, number _b of their level: two a level at most, however long the span.
    Where no span fills a shard, which one aggregate tells, there is no second table and the plans stay short.
    """
    s, e = F.col(start).cast("long"), F.col(end).cast("long")
    spans = df.select(*keys, s.alias("_s"), e.alias("_e")).where("_s <= _e").distinct()
    spans = cut(spans.withColumns({"_a": F.floor(F.col("_s") / width), "_z": F.floor(F.col("_e") / width)}))
    first = F.struct(F.col("_a").alias("k"), F.col("_s").alias("s"), F.least("_e", F.col("_a") * width + (width - 1)).alias("e"))
    last = F.struct(F.col("_z").alias("k"), (F.col("_z") * width).alias("s"), F.col("_e").alias("e"))
    ends = spans.select(*keys, F.explode(F.when(F.col("_a") == F.col("_z"), F.array(first)).otherwise(F.array(first, last))).alias("p"))
    ends = ends.select(*keys, F.col("p.k").alias("_k"), F.col("p.s").alias("_s"), F.col("p.e").alias("_e"))
    if (spans.agg(F.max(F.col("_z") - F.col("_a"))).first()[0] or 0) < 2:
        return ends, None
    # segment tree over the shards from _a + 1 up to _z: at each level the odd ends stand alone, the rest goes up
    lo = lambda l: F.ceil((F.col("_a") + 1) / F.pow(F.lit(2.0), l)).cast("long")
    hi = lambda l: F.floor(F.col("_z") / F.pow(F.lit(2.0), l)).cast("long")
    odd = lambda x: F.pmod(x, F.lit(2)) == 1
    block = lambda l, b: F.struct(l.alias("l"), b.alias("b"))
    levels = F.sequence(F.lit(0), F.floor(F.log2((F.col("_z") - F.col("_a") - 1).cast("double"))).cast("int"))
    pick = F.flatten(F.transform(levels, lambda l: F.array(F.when((lo(l) < hi(l)) & odd(lo(l)), block(l, lo(l))), F.when((lo(l) < hi(l)) & odd(hi(l)), block(l, hi(l) - 1)))))
    full = spans.where("_z > _a + 1").select(*keys, F.explode(F.filter(pick, lambda x: x.isNotNull())).alias("x")).select(*keys, "x.l", "x.b").distinct()
    size = F.pow(F.lit(2.0), F.col("l")).cast("long") * width
    return ends, full.select(*keys, F.col("l").alias("_l"), F.col("b").alias("_b"), (F.col("b") * size).alias("_s"), ((F.col("b") + 1) * size - 1).alias("_e"))


def _islands(df: DataFrame, by: list[str]) -> DataFrame:
    """Merge spans that overlap or touch, within ``by``."""
    w = Window.partitionBy(*by).orderBy("_s", "_e")
    before = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("_s") > before + 1), 1).otherwise(0)
    run = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*by, "_run").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).drop("_run")


def _edge(width: int) -> Column:
    return (F.col("_s") == F.col("_k") * width) | (F.col("_e") == F.col("_k") * width + (width - 1))


def _open_shards(local: DataFrame, full: DataFrame | None, keys: list[str]) -> DataFrame:
    """The rows of ``local`` in shards that no block fills: a shard meets the blocks above it by level and number."""
    if full is None:
        return local
    top = full.agg(F.max("_l").alias("_top"))
    shards = local.select(*keys, "_k").distinct().join(F.broadcast(top.where("_top IS NOT NULL")))  # one row
    up = shards.select(*keys, "_k", F.explode(F.sequence(F.lit(0), "_top")).alias("_l")).withColumn("_b", F.floor(F.col("_k") / F.pow(F.lit(2.0), F.col("_l"))))
    filled = up.join(full.select(*keys, "_l", "_b"), [*keys, "_l", "_b"], "left_semi").select(*keys, "_k").distinct()
    return local.join(filled, [*keys, "_k"], "left_anti")


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, width: int = SHARD) -> DataFrame:
    """Continuous stretches per key: (keys, start, end); spans that overlap or touch (next start = end + 1) become one.

    Keys must not be null: a row with a null key joins nothing and is left out.
    """
    ends, full = _pieces(_keyed(df, keys), keys, start, end, width)
    local = _islands(ends, [*keys, "_k"])
    inner = _open_shards(local.where(~_edge(width)), full, keys).select(*keys, "_s", "_e")
    stitched = _islands(_with(local.where(_edge(width)).select(*keys, "_s", "_e"), full, keys), keys)
    return inner.unionByName(stitched).select(*keys, F.col("_s").alias(start), F.col("_e").alias(end))


def _with(rows: DataFrame, full: DataFrame | None, keys: list[str]) -> DataFrame:
    return rows if full is None else rows.unionByName(full.select(*keys, "_s", "_e"))


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def interval_gaps(df: DataFrame, keys: list[str], start: str, end: str, width: int = SHARD) -> DataFrame:
    """Stretches between the first and the last covered position of a key that no span covers: (keys, start, end)."""
    ends, full = _pieces(_keyed(df, keys), keys, start, end, width)
    local = _islands(ends, [*keys, "_k"])
    w = Window.partitionBy(*keys, "_k").orderBy("_s")
    inside = local.withColumn("_n", F.lead("_s").over(w)).where("_n > _e + 1")
    inner = _open_shards(inside, full, keys).select(*keys, (F.col("_e") + 1).alias(start), (F.col("_n") - 1).alias(end))
    shards = local.groupBy(*keys, "_k").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e")).select(*keys, "_s", "_e")
    before = F.max("_e").over(Window.partitionBy(*keys).orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1))
    outer = _with(shards, full, keys).withColumn("_p", before).where("_s > _p + 1").select(*keys, (F.col("_p") + 1).alias(start), (F.col("_s") - 1).alias(end))
    return inner.unionByName(outer)


def overlaps(df: DataFrame, keys: list[str], ordinal: str, start: str, end: str, carry: list[str] = []) -> DataFrame:
    """Pairs of spans of one key that share a position, the lower ordinal at the left.

    An equality join on key and on the shards both spans touch, so a long entity is spread over tasks; a pair is
    kept in the shard where its overlap begins, hence once.
    """
    cols = [*keys, ordinal, start, end, *carry]
    spans = df.select(*cols).where(F.col(start) <= F.col(end))
    spans = spans.withColumn("_k", F.explode(F.sequence(F.floor(F.col(start) / SHARD), F.floor(F.col(end) / SHARD))))
    side = lambda p: spans.select(*keys, "_k", *[F.col(c).alias(f"{p}_{c}") for c in (ordinal, start, end, *carry)])
    lo = F.greatest(f"left_{start}", f"right_{start}")
    hi = F.least(f"left_{end}", f"right_{end}")
    pairs = side("left").join(side("right"), [*keys, "_k"]).where((F.col(f"left_{ordinal}") < F.col(f"right_{ordinal}")) & (lo <= hi) & (F.floor(lo / SHARD) == F.col("_k")))
    return pairs.withColumns({"overlap_start": lo, "overlap_end": hi}).drop("_k")


def coverage(spans: DataFrame, units: DataFrame, unit: str, start: str, end: str, length: str) -> DataFrame:
    """Per unit with a span and a text: covered and total positions. End -1 means the unit's last position.

    Units without a span, and units whose length is 0 or null, are left out of numerator and denominator.
    """
    s = spans.join(units.select(unit, length).where(F.col(length) > 0), unit)
    s = s.select(unit, length, start, F.when(F.col(end) == -1, F.col(length) - 1).otherwise(F.col(end)).alias(end))
    merged = merge_intervals(s, [unit, length], start, end)
    return merged.groupBy(unit, length).agg(F.sum(F.col(end) - F.col(start) + 1).alias("covered")).select(unit, "covered", F.col(length).cast("long").alias("total"))


def cover_ratio(per_unit: DataFrame) -> DataFrame:
    """One row: covered over total, 1.0 when nothing counts."""
    return per_unit.agg(F.coalesce(F.sum("covered") / F.sum("total"), F.lit(1.0)).alias("coverage"))


def overlap_tolerance(df: DataFrame, keys: list[str], start: str, end: str, tolerance: int) -> DataFrame:
    """Spans that reach more than ``tolerance`` positions into what earlier spans of the key cover."""
    shard = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_k", F.floor(F.col(start) / SHARD))
    w = lambda *by: Window.partitionBy(*by)
    back = (Window.unboundedPreceding, -1)
    # what the earlier shards reach, a row a shard, and what the earlier spans of the same shard do
    per = shard.groupBy(*keys, "_k").agg(F.max(end).alias("_m")).withColumn("_far", F.max("_m").over(w(*keys).orderBy("_k").rowsBetween(*back))).drop("_m")
    near = shard.withColumn("_near", F.max(end).over(w(*keys, "_k").orderBy(start, end).rowsBetween(*back)))
    both = near.join(per, [*keys, "_k"]).withColumn("prior_end", F.greatest("_near", "_far"))
    return both.where(F.col("prior_end") - F.col(start) + 1 > tolerance).select(*df.columns, "prior_end")


def _unit_texts(clusters: DataFrame) -> DataFrame:
    unit = F.format_string("%s|p%d_t%d", "document_id", "pdf_page_num", "cluster_number").alias("source_cluster_id")
    return clusters.where("text IS NOT NULL AND document_id IS NOT NULL").select(unit, "text")


def _lengths(texts: DataFrame) -> DataFrame:
    return texts.groupBy("source_cluster_id").agg(F.max(F.length("text")).cast("long").alias("n"))


def _resolved(pointers: DataFrame, lengths: DataFrame, how: str) -> DataFrame:
    """(source_cluster_id, span_start, span_end): distinct pointers with both bounds, ends resolved and clipped where the length is known."""
    e = F.col("end_char").cast("long")
    open_end = (e == -1) | (e >= 100_000_000)
    p = pointers.where("start_char IS NOT NULL AND end_char IS NOT NULL").select("source_cluster_id", "start_char", "end_char").distinct().join(lengths, "source_cluster_id", how)
    end = F.when(open_end, F.col("n") - 1).otherwise(F.least(e, F.col("n") - 1))  # least() passes over a null
    return p.select("source_cluster_id", F.greatest(F.col("start_char").cast("long"), F.lit(0).cast("long")).alias("span_start"), end.alias("span_end"))


def merged_pointers(pointers: DataFrame, clusters: DataFrame) -> DataFrame:
    """(source_cluster_id, span_start, span_end): the continuous stretches that all pointers with both bounds cover, per source unit.

    Ends count as in pointer_stretches. Where the unit's text is null or unknown a proper end stays as it is; an open
    end can't be told there and covers nothing, as does any pointer into an empty text.
    """
    return merge_intervals(_resolved(pointers, _lengths(_unit_texts(clusters)), "left"), ["source_cluster_id"], "span_start", "span_end")


def pointer_stretches(pointers: DataFrame, clusters: DataFrame, notes: DataFrame) -> DataFrame:
    """Per source unit the merged conflict and missing spans of the notes and the gaps between pointers.

    (span_kind, source_cluster_id, span_start, span_end). A pointer with a null bound points at nothing; an end of
    -1 or of 100,000,000 and more is the unit's last character; spans are clipped to the unit. Units whose text is
    null, empty or unknown have no gaps.
    """
    texts = _unit_texts(clusters)
    spans = _resolved(pointers, _lengths(texts).where("n > 0"), "inner")
    holes = interval_gaps(spans, ["source_cluster_id"], "span_start", "span_end")
    held = holes.join(texts, "source_cluster_id").where(F.expr("substring(text, span_start + 1, span_end - span_start + 1)").rlike(r"(?U)\S"))
    gaps = held.select(F.lit("gap").alias("span_kind"), "source_cluster_id", "span_start", "span_end").distinct()

    conflict = F.col("note_kind") == "conflict"
    said = notes.where(F.col("note_kind").isin("conflict", "gap") & F.col("source_cluster_id").isNotNull()).select(
        F.when(conflict, "conflict").otherwise("missing").alias("span_kind"),
        "source_cluster_id",
        F.when(conflict, F.col("overlap_start")).otherwise(F.col("gap_start")).cast("long").alias("span_start"),
        F.when(conflict, F.col("overlap_end")).otherwise(F.col("gap_end")).cast("long").alias("span_end"),
    )
    return gaps.unionByName(merge_intervals(said, ["span_kind", "source_cluster_id"], "span_start", "span_end"))
