"""Layer-wise growth of a semantic tree: invariants of a layer, guards, edits, and the frontier loop.

Children come in arrival order (``ord``); the first of equals is kept. Hooks propose and review layers; everything else
is relational. A pointer's end of -1 is the unit's last character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut
from .hierarchy import levels
from .intervals import SHARD, interval_gaps, overlaps

SPAN = "struct(source_cluster_id, start_char, end_char)"


def span_overlaps(pointers: DataFrame) -> DataFrame:
    """Pairs of children of one parent with pointers that share characters of one unit.

    (parent_id, source_cluster_id, left_child, right_child, overlap_start, overlap_end, conflict_kind), distinct; duplicate when
    both spans and both texts (without white space and case) are equal, else overlap. ``pointers`` has (parent_id,
    child_id, ord, source_cluster_id, start_char, end_char, verbatim_text) with resolved ends.
    """
    p = pointers.withColumn("said", X.squeeze_lower("verbatim_text"))
    pairs = overlaps(p, ["parent_id", "source_cluster_id"], "ord", "start_char", "end_char", ["child_id", "said"])
    same = (F.col("left_start_char") == F.col("right_start_char")) & (F.col("left_end_char") == F.col("right_end_char")) & (F.col("left_said") == F.col("right_said"))
    return pairs.where("left_child_id <> right_child_id").select(
        "parent_id", "source_cluster_id", F.col("left_child_id").alias("left_child"), F.col("right_child_id").alias("right_child"), "overlap_start", "overlap_end", F.when(same, "duplicate").otherwise("overlap").alias("conflict_kind")
    ).distinct()


def duplicate_children(children: DataFrame, pointers: DataFrame) -> DataFrame:
    """(parent_id, child_id, duplicate_of): children with the title and pointer fingerprint of an earlier one."""
    mark = F.concat_ws(":", "source_cluster_id", "start_char", "end_char", X.squeeze_lower("verbatim_text"))
    fp = pointers.groupBy("child_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ptr_ord", mark.alias("m")))), lambda x: x["m"]), "|").alias("fingerprint"))
    c = children.join(fp, "child_id", "left").withColumn("fingerprint", F.coalesce("fingerprint", F.lit(""))).withColumn("_t", F.lower(X.strip("title")))
    w = Window.partitionBy("parent_id", "_t", "fingerprint").orderBy("ord", "child_id")
    return c.withColumn("duplicate_of", F.first("child_id").over(w)).where("child_id <> duplicate_of").select("parent_id", "child_id", "duplicate_of")


def layer_gaps(parent_spans: DataFrame, child_spans: DataFrame, units: DataFrame) -> DataFrame:
    """Stretches of a parent's spans that its children leave out and that hold more than white space.

    Both have (parent_id, source_cluster_id, start_char, end_char). Parents without children are skipped; a stretch of
    an unknown unit is no gap.
    """
    keys = ["parent_id", "source_cluster_id"]
    have = child_spans.select("parent_id").distinct()
    p = parent_spans.where("start_char <= end_char").join(have, "parent_id", "left_semi").select(*keys, F.col("start_char").cast("long").alias("p_s"), F.col("end_char").cast("long").alias("p_e")).distinct()
    c = child_spans.select(*keys, F.col("start_char").cast("long").alias("s"), F.col("end_char").cast("long").alias("e"))
    # parents and children meet shard by shard, so a wide parent is spread over tasks
    shards = lambda d, a, b: d.withColumn("_k", F.explode(F.sequence(F.floor(F.col(a) / SHARD), F.floor(F.col(b) / SHARD))))
    at = F.col("_k") * SHARD
    clipped = shards(p, "p_s", "p_e").join(shards(c.where("s <= e").distinct(), "s", "e"), [*keys, "_k"]).select(*keys, "p_s", "p_e", F.greatest("s", "p_s", at).alias("s"), F.least("e", "p_e", at + (SHARD - 1)).alias("e")).where("s <= e")
    # the parent's span framed by one position on each side, so that its own ends count as covered neighbours
    frame = p.select(*keys, "p_s", "p_e", F.explode(F.array(F.struct((F.col("p_s") - 1).alias("s"), (F.col("p_s") - 1).alias("e")), F.struct((F.col("p_e") + 1).alias("s"), (F.col("p_e") + 1).alias("e")))).alias("f")).select(*keys, "p_s", "p_e", "f.s", "f.e")
    holes = interval_gaps(clipped.unionByName(frame), [*keys, "p_s", "p_e"], "s", "e")
    held = holes.join(units.select("source_cluster_id", "text"), "source_cluster_id").where(F.expr("substring(text, cast(s + 1 as int), cast(e - s + 1 as int))").rlike(rf"[^\s\x{{a0}}]"))
    return held.select(*keys, F.col("s").alias("gap_start"), F.col("e").alias("gap_end")).distinct()


def layer_flags(children: DataFrame, found: DataFrame, dup: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per parent with children: n_overlaps, n_duplicates, n_gaps, coverage_ok and satisfied."""
    n = lambda df, c: df.groupBy("parent_id").agg(F.count(F.lit(1)).alias(c))
    f = children.select("parent_id").distinct()
    for df, c in ((found, "n_overlaps"), (dup, "n_duplicates"), (gaps, "n_gaps")):
        f = f.join(n(df, c), "parent_id", "left").withColumn(c, F.coalesce(c, F.lit(0)))
    return f.withColumns({"coverage_ok": F.col("n_gaps") == 0, "satisfied": (F.col("n_gaps") == 0) & (F.col("n_overlaps") == 0) & (F.col("n_duplicates") == 0)})


def level_dedupe(nodes: DataFrame, spans: str) -> DataFrame:
    """The first node of each (type, normal title, set of spans). ``spans`` names an array column."""
    w = Window.partitionBy("node_type", X.normal_title("title"), F.array_sort(F.array_distinct(F.col(spans)))).orderBy("ord", "node_id")
    return nodes.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def layer_dedupe(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Children of known parents whose title isn't the parent's own, the first of each (parent, type, title)."""
    t = lambda c: F.lower(X.strip(F.coalesce(c, F.lit(""))))
    p = parents.select(F.col("node_id").alias("parent_id"), t("title").alias("_pt"))
    c = children.join(p, "parent_id").withColumn("_t", t("title")).where("_t <> _pt")
    w = Window.partitionBy("parent_id", "node_type", "_t").orderBy("ord", "node_id")
    return c.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_t", "_pt")


def mirror_guard(children: DataFrame, parents: DataFrame, spans: str) -> DataFrame:
    """Children unlike every node of the parent layer in type, normal title and set of spans."""
    key = lambda d, p: d.select(F.col("node_type").alias(f"{p}y"), X.normal_title("title").alias(f"{p}t"), F.array_sort(F.array_distinct(F.col(spans))).alias(f"{p}s"))
    ps = key(parents, "_p").distinct()
    c = children.withColumns({"_ct": X.normal_title("title"), "_cs": F.array_sort(F.array_distinct(F.col(spans)))})
    return c.join(ps, (F.col("node_type") == F.col("_py")) & F.col("_ct").eqNullSafe(F.col("_pt")) & F.col("_cs").eqNullSafe(F.col("_ps")), "left_anti").drop("_ct", "_cs")


def type_guard(children: DataFrame, parents: DataFrame, coerce: bool = False) -> DataFrame:
    """No KEY_VALUE_PAIR below a KEY_VALUE_PAIR: dropped, or turned into TEXT_FLOW."""
    p = parents.select(F.col("node_id").alias("parent_id"), F.col("node_type").alias("_pt"))
    c = children.join(p, "parent_id")
    bad = (F.col("node_type") == "KEY_VALUE_PAIR") & (F.col("_pt") == "KEY_VALUE_PAIR")
    out = c.withColumn("node_type", F.when(bad, "TEXT_FLOW").otherwise(F.col("node_type"))) if coerce else c.where(~bad)
    return out.drop("_pt")


def apply_edits(layer: DataFrame, edits: DataFrame) -> DataFrame:
    """ADD, DELETE and EDIT on one layer by node_id; unknown ids change nothing and deletes win over edits.

    ``edits`` has (action, node_id, node_type, title); null members of an edit keep the old value.
    """
    gone = edits.where("action = 'DELETE'").select("node_id").distinct()
    e = edits.where("action = 'EDIT'").groupBy("node_id").agg(F.max("node_type").alias("_y"), F.max("title").alias("_t"))
    kept = layer.join(gone, "node_id", "left_anti").join(e, "node_id", "left")
    kept = kept.withColumns({"node_type": F.coalesce("_y", "node_type"), "title": F.coalesce("_t", "title")}).drop("_y", "_t")
    new = edits.where("action = 'ADD'").select("node_id", "node_type", "title").join(layer.select("node_id"), "node_id", "left_anti")
    return kept.select("node_id", "node_type", "title").unionByName(new)


def frontier(nodes: DataFrame, max_depth: int | None = None, expandable: Callable | None = None) -> DataFrame:
    """(node_id, depth, wave_order): breadth-first from the nodes without a parent; wave_order counts within a depth, in arrival order.

    ``expandable`` gives a condition on node_type: children of other nodes aren't queued. Nodes that no root reaches aren't
    visited. The rounds of ``levels`` are the logarithm of the depth and not the depth.
    """
    n = nodes.where("node_id IS NOT NULL").groupBy(F.col("node_id").alias("id")).agg(
        F.min(F.nullif("parent_id", F.lit(""))).alias("parent"), F.min(F.col("ord") if "ord" in nodes.columns else F.lit(0)).alias("ord"), *([F.min("node_type").alias("node_type")] if expandable else [])
    )
    out = levels(n.withColumn("open", F.coalesce(expandable(), F.lit(False))) if expandable else n)
    out = out.where(F.col("depth") < max_depth) if max_depth is not None else out
    return out.select(F.col("id").alias("node_id"), F.col("depth").cast("int").alias("depth"), "wave_order")


def grow(roots: DataFrame, propose: Callable, review: Callable, max_depth: int = 10, max_retries: int = 3, strategies: tuple[str, ...] = ("excerpt_first", "boundary_first"), flags: Callable | None = None) -> tuple[DataFrame, list[dict]]:
    """Grow a tree layer by layer with hooks: (nodes, history).

    ``propose(parents, strategy, attempt)`` gives children (node_id, parent_id, node_type, title, ord); ``review(parents, children)``
    says whether the layer satisfies. An unsatisfied layer is proposed again up to max_retries times; then the strategy
    switches, once in the whole session; after that the run fails. Children are deduplicated before they are committed. ``flags(parents,
    children)`` gives ``layer_flags``: a parent whose invariants don't hold overrides the review.
    """
    nodes = cut(roots)
    layer, at, switched, history = nodes, 0, False, []
    for depth in range(max_depth):
        if not layer.limit(1).count():
            break
        tries = 0
        while True:
            children = cut(layer_dedupe(propose(layer, strategies[at], tries), layer))
            tries += 1
            good = bool(review(layer, children)) and (flags is None or not flags(layer, children).where("NOT satisfied").limit(1).count())
            history.append({"depth": depth, "strategy": strategies[at], "attempt": tries, "satisfied": good})
            if good:
                break
            if tries >= max_retries:
                if switched or at + 1 >= len(strategies):
                    raise RuntimeError(f"layer {depth} stays unsatisfied after {tries} proposals")
                switched, at, tries = True, at + 1, 0
        nodes = nodes.unionByName(children.select(*nodes.columns))
        layer = children.select(*nodes.columns)
    return nodes, history


def coverage_decision(parents: DataFrame, children: DataFrame, reviewed: bool | None = None, noted: bool | None = None, allow_empty: bool = False) -> bool:
    """The review's word, else the metadata's, else allow_empty, else every parent has a child."""
    for word in (reviewed, noted):
        if word is not None:
            return word
    return allow_empty or not parents.join(children.select(F.col("parent_id").alias("node_id")), "node_id", "left_anti").limit(1).count()
