"""Parent-child rows to full hierarchies.

``loops`` peels, in doubling steps, everything whose line of parents ends; what is left circles or hangs below a
circle. ``hierarchy`` lays an Euler tour through each remaining tree, ranks the tour by parallel list ranking over ruling
sets, and reads depth, root, subtree size and the entry and exit of every node from it: v lies below u exactly if u's
interval holds v's. Childless nodes take no part in the ranking; their place follows from their siblings. All rounds are
joins on keys, their number is the logarithm of the longest list, and lineage is cut in shared storage. Wide parents
are split by sibling buckets, so no window holds all children of one; joins on a wide parent's key are inner joins with one
row of it, which adaptive execution splits on the side of the children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .numbering import numbered

#: Consecutive numbers whose owners share a window when they have one parent.
BUCKET = 4096


def links(df: DataFrame, node: str, parent: str) -> DataFrame:
    """(id, parent): one row per id. A null or empty parent is none; of several different ones the smallest counts."""
    p = F.when(F.col(parent) != "", F.col(parent))
    return df.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("id")).agg(F.min(p).alias("parent"))


def other_parents(df: DataFrame, node: str, parent: str) -> DataFrame:
    """(id, parent): the links that ``links`` doesn't follow, of ids with several different parents."""
    p = F.when(F.col(parent) != "", F.col(parent))
    all_ = df.where(F.col(node).isNotNull()).select(F.col(node).alias("id"), p.alias("parent")).where("parent IS NOT NULL").distinct()
    first = all_.groupBy("id").agg(F.min("parent").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return all_.join(first, "id").where("parent <> _first").select("id", "parent")


def _known(rows: DataFrame) -> DataFrame:
    """(id, ptr) of the rows whose parent is itself a row."""
    ids = rows.select(F.col("id").alias("ptr"))
    return rows.where("parent IS NOT NULL").select("id", F.col("parent").alias("ptr")).join(ids, "ptr", "left_semi").select("id", "ptr")


def _step(cur: DataFrame) -> DataFrame:
    b = cur.select(F.col("id").alias("_at"), F.col("ptr").alias("_next"))
    return cur.join(b, cur["ptr"] == b["_at"]).select("id", F.col("_next").alias("ptr"))


def _endless(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(links, ends, n): all links among the rows, and (id, ptr) of the n ids whose line of parents never ends, with where it is after many steps."""
    first = cut(_known(rows))
    cur, n = first, first.count()
    while n:  # all lines of 2^k steps; if as many remain at twice the length, none of them ends
        after = cut(_step(cur))
        m = after.count()
        done, cur, n = m == n, after, m
        if done:
            break
    return first, cur, n


def loops(rows: DataFrame) -> DataFrame:
    """(id, loop_id, on_loop) of every id whose line of parents never ends; loop_id is the loop's smallest id.

    ``rows`` is what ``links`` gives. A parent that is no row ends the line; an id that is its own parent is a loop.
    """
    first, cur, n = _endless(rows)
    if not n:
        return rows.select("id", F.col("id").alias("loop_id"), F.lit(True).alias("on_loop")).limit(0)
    image = cur.select("ptr").distinct()
    size = image.count()
    while True:  # the ends of all lines of 2^k steps shrink until they are the loops themselves
        after = cut(_step(cur))
        image = after.select("ptr").distinct()
        m = image.count()
        cur = after
        if m == size:
            break
        size = m
    ring = cut(first.join(image.select(F.col("ptr").alias("id")), "id", "left_semi").select("id", "ptr", F.col("id").alias("low")))
    while True:  # smallest id of the next 2^k members; once no window gains by doubling, windows hold whole loops
        b = ring.select(F.col("id").alias("_at"), F.col("ptr").alias("_next"), F.col("low").alias("_low"))
        after = cut(ring.join(b, ring["ptr"] == b["_at"]).select("id", F.col("_next").alias("ptr"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("gain")))
        gained = after.where("gain").limit(1).count()
        ring = after.drop("gain")
        if not gained:
            break
    low = ring.select(F.col("id").alias("ptr"), F.col("low").alias("loop_id"))
    on = ring.select("id", F.lit(True).alias("on_loop"))
    return cur.join(low, "ptr").select("id", "loop_id").join(on, "id", "left").select("id", "loop_id", F.coalesce("on_loop", F.lit(False)).alias("on_loop"))


def _keyed(tree: DataFrame) -> DataFrame:
    """(id, k, p): ids and parents as numbers: consecutive, times four, plus two for a root; the lowest bit stays free.

    Numbers follow the column ord, where there is one, and the id, and so do siblings in the tour.
    """
    own = cut(numbered(tree, [*(["ord"] if "ord" in tree.columns else []), "id"], "_n").select("id", "ptr", (F.col("_n") * 4 + F.when(F.col("ptr").isNull(), 2).otherwise(0)).alias("k")))
    up = own.select(F.col("id").alias("ptr"), F.col("k").alias("p"))
    return cut(own.join(up, "ptr", "left").select("id", "k", "p"))


def _family(keyed: DataFrame) -> DataFrame:
    """(k, p, inner, bucket, before, sib, skip, prev): each child among its siblings; inner: it has children itself.

    before: childless siblings ahead of it; sib: the next sibling with children; skip: childless ones between (behind it, if
    none follows); prev: the last sibling with children ahead of it. Siblings come bucket by bucket, so that the windows
    over one parent's children hold a bucket each and those over its buckets a row each.
    """
    parents = keyed.where("p IS NOT NULL").select(F.col("p").alias("k"), F.lit(True).alias("inner")).distinct()
    kids = keyed.where("p IS NOT NULL").select("k", "p", F.floor(F.col("k") / (4 * BUCKET)).alias("bucket")).join(parents, "k", "left")
    kids = kids.withColumn("inner", F.coalesce("inner", F.lit(False)))
    w = Window.partitionBy("p", "bucket").orderBy("k")
    ahead, behind = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    leaf = (~F.col("inner")).cast("long")
    here = F.when(F.col("inner"), F.struct("k", "_before"))
    kids = kids.withColumn("_before", F.coalesce(F.sum(leaf).over(ahead), F.lit(0)))
    kids = kids.withColumns({"_next": F.first(here, ignorenulls=True).over(behind), "_prev": F.last(here, ignorenulls=True).over(ahead)})
    per = kids.groupBy("p", "bucket").agg(F.sum(leaf).alias("_leaves"), F.min(here).alias("_first"), F.max(here).alias("_last"))
    wb = Window.partitionBy("p").orderBy("bucket")
    lead, rest = wb.rowsBetween(Window.unboundedPreceding, -1), wb.rowsBetween(1, Window.unboundedFollowing)
    per = per.withColumn("_base", F.coalesce(F.sum("_leaves").over(lead), F.lit(0)))
    at = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.k").alias("k"), (F.col(f"{c}._before") + F.col("_base")).alias("before")))
    per = per.withColumns({"_after": F.first(at("_first"), ignorenulls=True).over(rest), "_ahead": F.last(at("_last"), ignorenulls=True).over(lead), "_all": F.sum("_leaves").over(Window.partitionBy("p"))})
    own = kids.join(per.select("p", "bucket", "_base", "_after", "_ahead", "_all"), ["p", "bucket"])
    sib, prev = F.coalesce(at("_next"), "_after"), F.coalesce(at("_prev"), "_ahead")
    before = F.col("_before") + F.col("_base")
    return own.select("k", "p", "inner", "bucket", before.alias("before"), sib["k"].alias("sib"), (F.coalesce(sib["before"], "_all") - before).alias("skip"), F.struct(prev["k"].alias("k"), prev["before"].alias("before")).alias("prev"))


def _tour(keyed: DataFrame, family: DataFrame) -> DataFrame:
    """Elements (e, next, w, d) of the Euler tours over the nodes with children: e = k on the way down, k + 1 on the way up.

    Childless nodes are no elements; w counts the element and the two steps of each that follows before the next one.
    """
    inner = keyed.select("k", "p").join(family.select(F.col("p").alias("k")).distinct(), "k", "left_semi")
    order = F.struct("bucket", "k")
    first = family.groupBy("p").agg(F.min_by(F.struct("k", "before"), F.when(F.col("inner"), order)).alias("_kid"), F.sum((~F.col("inner")).cast("long")).alias("_leaves"), F.count_if("inner").alias("_inner")).withColumnRenamed("p", "k")
    up = lambda c: F.col(c) + 1
    some = F.col("_inner") > 0
    base = inner.join(first, "k").join(family.where("inner").select("k", "sib", "skip"), "k", "left")
    down = F.struct(F.col("k").alias("e"), F.when(some, F.col("_kid.k")).otherwise(up("k")).alias("next"), (1 + 2 * F.when(some, F.col("_kid.before")).otherwise(F.col("_leaves"))).cast("long").alias("w"), F.lit(1).cast("long").alias("d"))
    back = F.struct(up("k").alias("e"), F.coalesce("sib", up("p")).alias("next"), (1 + 2 * F.coalesce("skip", F.lit(0))).cast("long").alias("w"), F.lit(-1).cast("long").alias("d"))
    return base.select(F.inline(F.array(down, back)))


#: One element in so many, by hash, rules the ones before it in the list.
RULERS = 16


def _rules(e: str) -> F.Column:
    """Is the element a ruler? The last one of each list is."""
    return (F.col(e).bitwiseAND(F.lit(3)) == 3) | (F.pmod(F.xxhash64(F.col(e)), F.lit(RULERS)) == 0)


def _jumped(cur: DataFrame, open_: F.Column) -> DataFrame:
    """One round: rows that ``open_`` selects take over where their pointer points."""
    b = cur.select(F.col("e").alias("_e"), F.col("next").alias("_n"), F.col("w").alias("_w"), F.col("d").alias("_d"))
    moved = cur.where(open_).join(b, F.col("next") == F.col("_e")).select("e", F.col("_n").alias("next"), (F.col("w") + F.col("_w")).alias("w"), (F.col("d") + F.col("_d")).alias("d"))
    return cut(cur.where(~open_).unionByName(moved))


def _ranked(tour: DataFrame) -> DataFrame:
    """(e, last, hops, d): the last element of each element's list, and the steps and the sum of d from it to the end.

    Ruling sets: every element jumps to the next ruler, in as many rounds as the logarithm of the longest way between
    two; the rulers alone, a short list, are ranked by pointer jumping; then each element adds its ruler's rank.
    """
    cur = cut(tour)
    end = F.col("next").isNull()
    open_ = ~end & ~_rules("next")
    while cur.where(open_).limit(1).count():
        cur = _jumped(cur, open_)
    short = cut(cur.where(_rules("e")))
    far = ~end & (F.col("next").bitwiseAND(F.lit(3)) != 3)
    while short.where(far).limit(1).count():
        short = _jumped(short, far)
    # a ruler that points at the end lacks the end's own step
    rank = short.select(F.col("e").alias("_r"), F.coalesce("next", "e").alias("last"), (F.col("w") + F.when(end, 0).otherwise(1)).alias("_w"), (F.col("d") - F.when(end, 0).otherwise(1)).alias("_d"))
    whole = cur.where(~end).join(rank, F.col("next") == F.col("_r")).select("e", "last", (F.col("w") + F.col("_w")).alias("hops"), (F.col("d") + F.col("_d")).alias("d"))
    return whole.unionByName(cur.where(end).select("e", F.col("e").alias("last"), F.col("w").alias("hops"), "d"))


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, keyed, family): nodes is (k, r, depth, entry, exit) of every id whose line of parents ends, r being its root's number."""
    known, bad, n = _endless(rows)
    order = [c for c in ("ord",) if c in rows.columns]
    free = rows.select("id", *order)
    keyed = _keyed((free.join(bad.select("id"), "id", "left_anti") if n else free).join(known, "id", "left"))
    family = cut(_family(keyed))
    ranked = cut(_ranked(_tour(keyed, family)))
    odd = F.col("e").bitwiseAND(F.lit(1)) == 1
    down = ranked.where(~odd).select(F.col("e").alias("k"), (F.col("last") - 1).alias("r"), F.col("hops").alias("_down"), (-F.col("d")).alias("depth"))
    up = ranked.where(odd).select((F.col("e") - 1).alias("k"), F.col("hops").alias("_up"))
    length = ranked.where(F.col("last") - 1 == F.col("e")).select(F.col("e").alias("r"), F.col("hops").alias("_len"))
    inner = cut(down.join(up, "k").join(length, "r").select("k", "r", "depth", (F.col("_len") - F.col("_down")).alias("entry"), (F.col("_len") - F.col("_up")).alias("exit")))
    # childless nodes count on from the sibling with children before them, or from their parent
    leaf = family.where("NOT inner").select("k", "p", "before", "prev")
    at = inner.select(F.col("k").alias("p"), "r", "depth", F.col("entry").alias("_in"))
    sib = inner.select(F.col("k").alias("_s"), F.col("exit").alias("_out"))
    placed = leaf.join(at, "p").join(sib, F.col("prev.k") == F.col("_s"), "left")
    entry = F.coalesce(F.col("_out") + 1 + 2 * (F.col("before") - F.col("prev.before")), F.col("_in") + 1 + 2 * F.col("before"))
    leaves = placed.select("k", "r", (F.col("depth") + 1).alias("depth"), entry.alias("entry"), (entry + 1).alias("exit"))
    alone = keyed.where("p IS NULL").join(inner.select("k"), "k", "left_anti").select("k", F.col("k").alias("r"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("entry"), F.lit(1).cast("long").alias("exit"))
    return inner.unionByName(leaves).unionByName(alone), keyed, family


def hierarchy(rows: DataFrame, separator: str = "/") -> DataFrame:
    """(id, root, depth, path, ancestors, entry, exit, n_descendants) of every id whose line of parents ends.

    Entry and exit number the tour of the node's tree from 0. A root is an id without a parent among the rows. Ids
    on or below a loop are in ``loops`` and not here.
    """
    nodes, keyed, family = _placed(cut(rows))
    own = nodes.join(_paths(keyed, family), "k")
    return own.select(
        "id", F.get("ancestry", F.lit(0)).alias("root"), "depth", F.array_join("ancestry", separator).alias("path"), F.slice("ancestry", 1, F.size("ancestry") - 1).alias("ancestors"), "entry", "exit", ((F.col("exit") - F.col("entry") - 1) / 2).cast("long").alias("n_descendants")
    )


def tours(rows: DataFrame) -> DataFrame:
    """(id, root, entry, exit) of ``hierarchy`` without the paths, which are as long as the trees are deep."""
    nodes, keyed, _ = _placed(cut(rows))
    names = keyed.select("k", "id")
    return nodes.join(names, "k").join(names.select(F.col("k").alias("r"), F.col("id").alias("root")), "r").select("id", "root", "entry", "exit")


#: Codes of ancestors that a place in the tree holds before one code stands for it.
WIDEST = 64


def _coded(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Adds ``name``: numbers with gaps in the order of the columns, no two alike; the bits from the 34th on are the partition."""
    return cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id()))


def _ways(inner: DataFrame) -> DataFrame:
    """(id, depth, way) of the ids whose line of parents ends at one without; of two in one depth, the walk meets the one of the smaller way first.

    A way has the codes from the root down, joined over 2^k ancestors a round. An id's code is its own and only ids of
    one depth are compared, whose ways are of one length, so a code in the order of the ways can stand for each of them.
    """
    own = _coded(inner, ["ord", "id"], "k").select("id", "parent", "k", F.array("k").alias("way"))
    up = own.select(F.col("id").alias("parent"), F.col("k").alias("ptr"))
    none = F.lit(None).cast("long")
    cur = own.where("parent IS NULL").select("id", "k", none.alias("ptr"), F.lit(0).cast("long").alias("depth"), "way")
    cur = cut(cur.unionByName(own.join(up, "parent").select("id", "k", "ptr", F.lit(1).cast("long").alias("depth"), "way")))
    width, n = 1, -1
    while True:
        m = cur.where("ptr IS NOT NULL").count()
        if m in (0, n):  # if as many lines go on at twice the length, none of them ends
            return cur.where("ptr IS NULL").select("id", "depth", "way")
        b = cur.select(F.col("k").alias("_at"), F.col("ptr").alias("_next"), F.col("depth").alias("_d"), F.col("way").alias("_way"))
        moved = cur.where("ptr IS NOT NULL").join(b, F.col("ptr") == F.col("_at")).select("id", "k", F.col("_next").alias("ptr"), (F.col("depth") + F.col("_d")).alias("depth"), F.concat("_way", "way").alias("way"))
        cur, width, n = cur.where("ptr IS NULL").unionByName(moved), 2 * width, m
        if width < WIDEST:
            cur = cut(cur)
        else:
            cur, width = _coded(cur, ["way"], "_c").select("id", "k", "ptr", "depth", F.array("_c").alias("way")), 1


def levels(rows: DataFrame) -> DataFrame:
    """(id, depth, wave_order): each id's depth and its place among those of the same depth, as a walk breadth-first meets them.

    ``rows`` is (id, parent[, ord][, open]), a row per id; siblings and roots come by ord and id. The walk starts at the ids without
    a parent and doesn't go on from ids that aren't open; what it doesn't meet is left out. Childless ids take no part in the rounds:
    in a level all follow the places of their parents.
    """
    have = rows.columns
    rows = cut(rows.select("id", "parent", F.col("ord") if "ord" in have else F.lit(0).alias("ord"), F.col("open") if "open" in have else F.lit(True).alias("open")))
    below = rows.where("parent IS NOT NULL")
    inner = rows.where("open").join(below.select(F.col("parent").alias("id")).distinct(), "id", "left_semi").select("id", "parent", "ord")
    up = _coded(_ways(inner), ["depth", "way"], "up").select(F.col("id").alias("parent"), (F.col("depth") + 1).alias("depth"), "up")
    met = rows.where("parent IS NULL").select("id", F.lit(0).cast("long").alias("depth"), F.lit(-1).cast("long").alias("up"), "ord").unionByName(below.join(up, "parent").select("id", "depth", "up", "ord"))
    at = _coded(met, ["up", "ord", "id"], "_n").select("id", "depth", "_n", F.shiftright("_n", 33).alias("_p"))
    # in a partition a level is a run of numbers; it goes on from those of the partitions before
    per = at.groupBy("depth", "_p").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_count"))
    ahead = Window.partitionBy("depth").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("depth", "_p", (F.coalesce(F.sum("_count").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"))
    return at.join(per, ["depth", "_p"]).select("id", "depth", (F.col("_n") + F.col("_shift")).alias("wave_order"))


def heights(rows: DataFrame) -> DataFrame:
    """(id, height): steps to the farthest descendant, 0 for childless ids; none for ids on a loop.

    In round k every id tells the one 2^k above it how far down it knows; the rounds are the logarithm of the height.
    """
    rows = cut(rows)
    ring = loops(rows).where("on_loop").select("id")
    free = cut(rows.select("id", "parent").join(ring, "id", "left_anti"))
    cur = cut(free.select("id").join(_known(free), "id", "left").withColumn("h", F.lit(0).cast("long")))
    step = 1
    while cur.where("ptr IS NOT NULL").limit(1).count():
        told = cur.where("ptr IS NOT NULL").groupBy(F.col("ptr").alias("id")).agg((F.max("h") + step).alias("_h"))
        far = cur.select(F.col("id").alias("ptr"), F.col("ptr").alias("_next"))
        cur = cut(cur.join(told, "id", "left").join(far, "ptr", "left").select("id", F.col("_next").alias("ptr"), F.greatest("h", F.coalesce("_h", F.lit(0))).alias("h")))
        step *= 2
    return cur.select("id", F.col("h").alias("height"))


def _paths(keyed: DataFrame, family: DataFrame) -> DataFrame:
    """(k, id, ancestry): the ids from the root down to each; joined over 2^k ancestors a round, for childless nodes once at the end."""
    inner = family.select(F.col("p").alias("k")).distinct()
    cur = cut(keyed.join(inner, "k", "left_semi").select("k", "id", F.col("p").alias("ptr"), F.array("id").alias("ancestry")))
    while cur.where("ptr IS NOT NULL").limit(1).count():
        b = cur.select(F.col("k").alias("_at"), F.col("ptr").alias("_next"), F.col("ancestry").alias("_path"))
        open_ = cur.where("ptr IS NOT NULL").join(b, F.col("ptr") == F.col("_at")).select("k", "id", F.col("_next").alias("ptr"), F.concat("_path", "ancestry").alias("ancestry"))
        cur = cut(cur.where("ptr IS NULL").unionByName(open_))
    rest = keyed.join(inner, "k", "left_anti").join(cur.select(F.col("k").alias("p"), F.col("ancestry").alias("_up")), "p", "left")
    return cur.select("k", "id", "ancestry").unionByName(rest.select("k", "id", F.concat(F.coalesce("_up", F.array().cast("array<string>")), F.array("id")).alias("ancestry")))


def descendants(tree: DataFrame) -> DataFrame:
    """(ancestor, descendant) for all pairs of a ``hierarchy``: as many rows as the depths add up to.

    The tour holds the same relation in one row per node: within a root, v lies below u exactly if
    ``u.entry < v.entry AND v.exit < u.exit``.
    """
    return tree.select(F.explode("ancestors").alias("ancestor"), F.col("id").alias("descendant"))


def loop_members(nodes: DataFrame, events: DataFrame) -> DataFrame:
    """(tree, member_id, loop_id) of the nodes and runs whose line of parents runs into a loop."""
    part = lambda kind, rows: loops(rows).select(F.lit(kind).alias("tree"), F.col("id").alias("member_id"), "loop_id")
    return part("node", links(nodes, "node_id", "parent_id")).unionByName(part("run", links(events, "run_id", "parent_run_id")))
