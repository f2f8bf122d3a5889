"""The review session of a layer-wise parse: roots, frontier, review with invariants, commit, and the gate at the end.

A session is a collection. Everything is a table: the frontier (collection_id, parent_node_id, depth, order), the nodes, the children
proposed for a layer, and one row of verdict per session. Hooks give tables too, and invariants have the last word over them.
Null ids belong to no session; an empty frontier gives an empty layer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .grounding import ground, layer_repair
from .layers import duplicate_children, layer_gaps, level_dedupe, span_overlaps
from .numbering import numbered

POINTER = ["source_cluster_id", "start_char", "end_char", "verbatim_text"]


def within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... in the order within each group, without a task that holds a group."""
    n = numbered(df.where(F.col(group).isNotNull()), [group, *order], "_nth")
    first = n.groupBy(F.col(group).alias("_g")).agg(F.min("_nth").alias("_lowest"))
    return n.join(first, F.col(group) == F.col("_g")).withColumn(name, F.col("_nth") - F.col("_lowest")).drop("_nth", "_g", "_lowest")


def page_units(units: DataFrame) -> DataFrame:
    """Units with their place in the collection: by page, cluster number (none counts as 0) and unit id."""
    return within(units.withColumn("_c", F.coalesce("cluster_number", F.lit(0))), "collection_id", ["page_number", "_c", "unit_id"], "place").drop("_c")


def init_session(units: DataFrame, titles: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, pointers, frontier) of every collection.

    A root has one pointer per text unit, from 0 to -1, in the lexicographic order of the unit ids. ``titles`` has
    (collection_id, title); without one the collection's id is its title.
    """
    c = units.where("collection_id IS NOT NULL").select("collection_id").distinct()
    c = c.join(titles, "collection_id", "left") if titles is not None else c.withColumn("title", F.lit(None).cast("string"))
    root = F.concat("collection_id", F.lit("|root"))
    roots = c.select("collection_id", root.alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("DOCUMENT_ROOT").alias("node_type"), F.coalesce("title", "collection_id").alias("title"), F.lit(0).alias("level_from_root"))
    text = units.where(F.col("modality").isin("text", "ocr_text")).select("collection_id", "unit_id", "text").distinct()
    p = within(text, "collection_id", ["unit_id"], "ptr_ord").select(root.alias("node_id"), F.col("ptr_ord").cast("int").alias("ptr_ord"), F.col("unit_id").alias("source_cluster_id"), F.lit(0).alias("start_char"), F.lit(-1).alias("end_char"), F.coalesce("text", F.lit("")).alias("verbatim_text"))
    return roots, p, c.select("collection_id", root.alias("parent_node_id"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("order"))


def prepare_frontier(frontier: DataFrame, nodes: DataFrame, pointers: DataFrame, attempts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(layer, rest): every item of each session's smallest depth, with the parent's title (its id where none is known), pointers and tries so far."""
    low = frontier.groupBy("collection_id").agg(F.min("depth").alias("_low"))
    f = frontier.join(low, "collection_id")
    n = nodes.select(F.col("node_id").alias("parent_node_id"), "title").dropDuplicates(["parent_node_id"])
    p = pointers.groupBy(F.col("node_id").alias("parent_node_id")).agg(F.count(F.lit(1)).alias("n_pointers"))
    layer = f.where(F.col("depth") == F.col("_low")).drop("_low").join(n, "parent_node_id", "left").join(p, "parent_node_id", "left")
    tries = F.lit(0)
    if attempts is not None:
        layer, tries = layer.join(attempts.select("collection_id", "depth", F.col("tries").alias("_t")), ["collection_id", "depth"], "left"), F.coalesce("_t", F.lit(0))
    layer = layer.select("collection_id", "parent_node_id", "depth", "order", F.coalesce("title", "parent_node_id").alias("title"), F.coalesce("n_pointers", F.lit(0)).alias("n_pointers"), tries.alias("retry_count"))
    return layer, f.where(F.col("depth") > F.col("_low")).drop("_low")


def replayed(layer: DataFrame, full_tree: DataFrame) -> DataFrame:
    """The children that a whole tree, parsed at once, has for the layer's parents."""
    return full_tree.join(layer.select(F.col("parent_node_id").alias("parent_id")), "parent_id", "left_semi")


def review_layer(layer: DataFrame, children: DataFrame, child_pointers: DataFrame, parent_spans: DataFrame, units: DataFrame, said: DataFrame | None = None, checked: bool = True) -> DataFrame:
    """(collection_id, depth, satisfied, coverage_ok, n_overlaps, n_duplicates, n_gaps, notes, tries, checked): one row per session.

    ``said`` is the hook's word (collection_id, satisfied, notes); nothing said counts as satisfied. Overlaps, duplicates and
    gaps override it. With ``checked`` off (no review, or a replayed tree) all is taken as covered and satisfied.
    """
    s = layer.groupBy("collection_id").agg(F.max("depth").alias("depth"), (F.max("retry_count") + 1).alias("tries"))
    none = F.array().cast("array<string>")
    if not checked:
        zero = {c: F.lit(0).cast("long") for c in ("n_overlaps", "n_duplicates", "n_gaps")}
        return s.select("collection_id", "depth", F.lit(True).alias("satisfied"), F.lit(True).alias("coverage_ok"), *[v.alias(k) for k, v in zero.items()], none.alias("notes"), "tries", F.lit(False).alias("checked"))
    where = layer.select("collection_id", F.col("parent_node_id").alias("parent_id")).distinct()
    own = children.join(where.select("parent_id"), "parent_id", "left_semi")
    over = span_overlaps(child_pointers)
    dup = duplicate_children(own, child_pointers)
    gaps = layer_gaps(parent_spans, child_pointers, units)
    found = [
        over.select("parent_id", F.lit("n_overlaps").alias("kind"), F.format_string("overlap conflict: %s vs %s @ %s:%d-%d", "left_child", "right_child", "source_cluster_id", "overlap_start", "overlap_end").alias("note")),
        dup.select("parent_id", F.lit("n_duplicates").alias("kind"), F.format_string("duplicate child: %s duplicates %s", "child_id", "duplicate_of").alias("note")),
        gaps.select("parent_id", F.lit("n_gaps").alias("kind"), F.format_string("coverage gap: %s %s:%d-%d", "parent_id", "source_cluster_id", "gap_start", "gap_end").alias("note")),
    ]
    all_ = found[0].unionByName(found[1]).unionByName(found[2]).join(where, "parent_id")
    per = all_.groupBy("collection_id").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("n_overlaps", "n_duplicates", "n_gaps")], F.array_sort(F.collect_set("note")).alias("_found"))
    r = s.join(per, "collection_id", "left")
    r = r.join(said.select("collection_id", F.col("satisfied").alias("_base"), F.col("notes").alias("_said")), "collection_id", "left") if said is not None else r.withColumns({"_base": F.lit(None).cast("boolean"), "_said": none})
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    clean = F.coalesce(F.col("n_overlaps") + F.col("n_duplicates") + F.col("n_gaps"), F.lit(0)) == 0
    return r.select("collection_id", "depth", (F.coalesce("_base", F.lit(True)) & clean).alias("satisfied"), (F.coalesce("n_gaps", F.lit(0)) == 0).alias("coverage_ok"), z("n_overlaps"), z("n_duplicates"), z("n_gaps"), merged_notes(F.coalesce("_said", none), F.coalesce("_found", none)).alias("notes"), "tries", F.lit(True).alias("checked"))


def merged_notes(a: F.Column, b: F.Column) -> F.Column:
    """Notes of both lists, each once, in their first order."""
    return F.array_union(a, b)


def apply_review(results: DataFrame, reviews: DataFrame) -> DataFrame:
    """Layer results (collection_id, satisfied, review_rounds, metadata map) with a review's words merged in: one round more, its metadata over the old."""
    said = F.map_filter(
        F.create_map(F.lit("split_strategy"), F.col("strategy_used"), F.lit("layer_coverage_ok"), F.col("coverage_ok").cast("string"), F.lit("review_notes"), F.when(F.size("notes") > 0, F.to_json("notes"))), lambda k, v: v.isNotNull()
    )
    r = reviews.select("collection_id", F.col("satisfied").alias("_s"), said.alias("_m"))
    over = lambda old, new: F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    j = results.join(r, "collection_id", "left")
    hit = F.col("_m").isNotNull()
    return j.withColumns({"satisfied": F.coalesce("_s", "satisfied"), "review_rounds": F.col("review_rounds") + hit.cast("int"), "metadata": F.when(hit, over(F.col("metadata"), F.col("_m"))).otherwise(F.col("metadata"))}).drop("_s", "_m")


def commit_layer(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The nodes with the children put below their parents, one level deeper; children of unknown parents are left out, and so are ids that are there."""
    up = nodes.select(F.col("node_id").alias("parent_id"), F.col("level_from_root").alias("_l")).dropDuplicates(["parent_id"])
    new = children.join(up, "parent_id").withColumn("level_from_root", F.col("_l") + 1).join(nodes.select("node_id"), "node_id", "left_anti")
    return nodes.unionByName(new.select(*nodes.columns))


def enqueue(rest: DataFrame, layer: DataFrame, children: DataFrame, max_depth: int) -> DataFrame:
    """The frontier after a layer: expandable children queue behind what is left, in arrival order; nothing below ``max_depth``.

    A child without an ``expandable`` column is expandable unless it is a KEY_VALUE_PAIR.
    """
    at = layer.select("collection_id", "depth", F.col("parent_node_id").alias("parent_id"), F.col("order").alias("_up")).distinct()
    may = F.col("expandable") if "expandable" in children.columns else F.col("node_type") != "KEY_VALUE_PAIR"
    new = children.where(may).join(at, "parent_id").where(F.col("depth") + 1 < max_depth)
    new = within(new.select("collection_id", F.col("node_id").alias("parent_node_id"), (F.col("depth") + 1).alias("depth"), "_up", "ord"), "collection_id", ["_up", "ord", "parent_node_id"], "_n")
    last = rest.groupBy("collection_id").agg((F.max("order") + 1).alias("_last"))
    new = new.join(last, "collection_id", "left").select("collection_id", "parent_node_id", "depth", (F.col("_n") + F.coalesce("_last", F.lit(0))).alias("order"))
    return rest.select("collection_id", "parent_node_id", "depth", "order").unionByName(new)


def find_node(nodes: DataFrame, node_id: str) -> DataFrame:
    """The row of a node; the first in arrival order where an id comes again."""
    return nodes.where(F.col("node_id") == node_id).orderBy("ord").limit(1)


def validation_gate(coverage: DataFrame, threshold: float = 0.99) -> DataFrame:
    """(coverage, passed, error): one row from ``intervals.cover_ratio``."""
    ok = F.col("coverage") >= threshold
    return coverage.select("coverage", ok.alias("passed"), F.when(~ok, F.format_string("text coverage below threshold: %.3f < %.3f", "coverage", F.lit(threshold))).alias("error"))


def prompt_view(children: DataFrame, pointers: DataFrame, excerpts: int = 2, chars: int = 120) -> DataFrame:
    """(parent_id, local_id, node_id, node_type, title, pointers): children as a model sees them: numbered within the parent, first pointers only, long texts clipped."""
    said = F.coalesce("verbatim_text", F.lit(""))
    short = F.concat(F.substring(said, 1, chars), F.when(F.length(said) > chars, "…").otherwise(""))
    p = pointers.groupBy("node_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("ptr_ord", "source_cluster_id", "start_char", "end_char", short.alias("verbatim_text")))), 1, excerpts).alias("pointers"))
    n = within(children, "parent_id", ["ord", "node_id"], "local_id")
    return n.join(p, "node_id", "left").select("parent_id", "local_id", "node_id", "node_type", "title", "pointers")


def split_by(df: DataFrame, condition: F.Column) -> tuple[DataFrame, DataFrame]:
    """The rows that meet the condition, and all others, those it says nothing about among them."""
    return df.where(condition), df.where(~F.coalesce(condition, F.lit(False)))


def unmatched_ids(returned: DataFrame, sent: DataFrame, key: str) -> DataFrame:
    """(key, side): ids that came back without having been sent (extra) and the other way round (missing); null ids are none."""
    one = lambda df, c: df.where(F.col(key).isNotNull()).select(key).distinct().withColumn(c, F.lit(True))
    j = one(returned, "_r").join(one(sent, "_s"), key, "full")
    return j.where("_r IS NULL OR _s IS NULL").select(key, F.when(F.col("_s").isNull(), "extra").otherwise("missing").alias("side"))


EDIT = ["seq", "edit_type", "target_id", "target_type", "target_title", "parent_id", "node_type", "title", "valid"]


def apply_proposals(layer: DataFrame, proposals: DataFrame) -> DataFrame:
    """ADD_NODE, DELETE_NODE and EDIT_NODE on one layer; both tables have a collection_id and are worked on session by session.

    ``layer`` has (collection_id, local_id, parent_id, node_type, title, spans). A target is the local id as text, else the first child of
    the type with the (normal) title. Proposals are taken against the layer as it was shown: of several edits of a child the last
    wins member by member, an edit behind a deletion does nothing. Additions without a parent go to the first child's; edits and additions
    that are not ``valid`` (a pointer can't be grounded) are dropped. At the end equal types, titles and spans count once.
    """
    from ..functions import text as X

    kids = layer.select("collection_id", "local_id", X.normal_title("title").alias("_t"), F.col("node_type").alias("_y"))
    p = proposals.where("edit_type IN ('DELETE_NODE', 'EDIT_NODE')").withColumns({"_id": F.col("target_id").try_cast("long"), "_tt": X.normal_title("target_title")})
    by_id = p.join(kids.select("collection_id", F.col("local_id").alias("_id"), F.lit(True).alias("_hit")), ["collection_id", "_id"], "left")
    first = kids.groupBy("collection_id", "_y", "_t").agg(F.min("local_id").alias("_named"))
    named = by_id.join(first.select("collection_id", F.col("_y").alias("target_type"), F.col("_t").alias("_tt"), "_named"), ["collection_id", "target_type", "_tt"], "left")
    # an id that is no number finds nothing, not even by its title
    at = named.withColumn("local_id", F.when(F.col("_hit"), F.col("_id")).when(F.col("target_id").isNotNull() & (F.col("target_id") != "") & F.col("_id").isNull(), None).otherwise(F.col("_named"))).where("local_id IS NOT NULL")
    key = ["collection_id", "local_id"]
    gone = at.where("edit_type = 'DELETE_NODE'").groupBy(*key).agg(F.min("seq").alias("_gone"))
    edit = at.where("edit_type = 'EDIT_NODE' AND valid")
    pick = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"_{c}")
    edits = edit.groupBy(*key).agg(pick("parent_id"), pick("node_type"), pick("title"), *([pick("spans")] if "spans" in edit.columns else []))
    kept = layer.join(gone.select(*key), key, "left_anti").join(edits, key, "left")
    for c in ("parent_id", "node_type", "title", *(["spans"] if "spans" in edit.columns else [])):
        kept = kept.withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    top = layer.groupBy("collection_id").agg((F.max("local_id") + 1).alias("_next"), F.min_by("parent_id", "local_id").alias("_first"))
    new = within(proposals.where("edit_type = 'ADD_NODE' AND valid"), "collection_id", ["seq"], "_n").join(top, "collection_id", "left")
    spans = F.col("spans") if "spans" in proposals.columns else F.array().cast("array<string>")
    new = new.select("collection_id", (F.coalesce("_next", F.lit(0)) + F.col("_n")).alias("local_id"), F.coalesce(F.nullif("parent_id", F.lit("")), "_first").alias("parent_id"), "node_type", "title", spans.alias("spans"))
    both = kept.select("collection_id", "local_id", "parent_id", "node_type", "title", "spans").unionByName(new)
    marked = both.withColumns({"_k": F.concat(F.array(F.col("collection_id")), "spans"), "ord": F.col("local_id"), "node_id": F.col("local_id").cast("string")})
    return level_dedupe(marked, "_k").drop("_k", "ord", "node_id")


def edit_loop(layer: DataFrame, propose: Callable, guard: Callable = lambda layer: layer, rounds: int = 3) -> tuple[DataFrame, int]:
    """(layer, rounds with changes): proposals are asked for and applied until none come, three times at most; the guard runs before and after each round."""
    done = 0
    layer = cut(guard(layer))
    while done < rounds:
        proposals = cut(propose(layer, done))
        if not proposals.limit(1).count():
            break
        layer = cut(guard(apply_proposals(layer, proposals)))
        done += 1
    return layer, done


def level_repair(children: DataFrame, pointers: DataFrame, units: DataFrame, hook: Callable | None = None, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(fixed, pending): a layer's children (node_id, parent_id, title, ord) with pointers that can be grounded, and the rest as they were.

    Of children with one parent and title the last counts. Each round grounds what is pending, all pointers of a child or
    none, and asks ``hook(children, pointers)`` for new pointers of those that are left. fixed has (node_id, round) and the pointers.
    """
    last = children.groupBy("parent_id", "title").agg(F.max_by(F.struct("node_id"), F.struct("ord", "node_id")).alias("_k")).select(F.col("_k.node_id").alias("node_id"))
    pending = cut(children.join(last, "node_id", "left_semi"))
    own, fixed = pointers.join(last, "node_id", "left_semi"), None
    cols = ["node_id", "ptr_ord", "source_cluster_id", "start_char", "end_char", "verbatim_text"]
    for r in range(rounds):
        if not pending.limit(1).count():
            break
        g = cut(ground(own.select(*cols).join(pending.select("node_id"), "node_id", "left_semi"), units))
        good = layer_repair(g).where("repaired").select("node_id")
        done = g.join(good, "node_id", "left_semi").select("node_id", F.lit(r).alias("round"), "ptr_ord", "source_cluster_id", F.col("new_start").alias("start_char"), F.col("new_end").alias("end_char"), F.col("new_text").alias("verbatim_text"))
        fixed = done if fixed is None else fixed.unionByName(done)
        pending = cut(pending.join(good, "node_id", "left_anti"))
        if hook is None:
            break
        own = cut(hook(pending, own).select(*cols))
    return fixed, pending
