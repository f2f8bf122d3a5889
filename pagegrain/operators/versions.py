"""Version chains of files, duplicate ledgers, and page-sequence containment.

A chain is a doubly linked list of nodes; its order is re-derived with window functions instead of relinking rows one by
one. One file's pages are contained in another's when they stand there contiguously and in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def chain_positions(nodes: DataFrame) -> DataFrame:
    """(chain_id, id, position): each chain's nodes from its head (no previous node, or one outside the chain), by following next.

    Pointer jumping over prev: all positions after as many rounds as the logarithm of the longest chain. Nodes on a loop
    have no head and are left out.
    """
    n = nodes.select("id", "chain_id", "prev_id").distinct()
    have = n.select(F.col("id").alias("prev_id"), "chain_id")
    linked = n.where("prev_id IS NOT NULL").join(have, ["prev_id", "chain_id"], "left_semi").select("id", "chain_id", "prev_id")
    cur = cut(n.select("id", "chain_id").join(linked, ["id", "chain_id"], "left").select("id", "chain_id", F.col("prev_id").alias("ptr"), F.when(F.col("prev_id").isNull(), 0).otherwise(1).alias("hops")))
    left = cur.where("ptr IS NOT NULL").count()
    while left:
        b = cur.select(F.col("id").alias("_id"), F.col("ptr").alias("_ptr"), F.col("hops").alias("_h"))
        more = cur.where("ptr IS NOT NULL").join(b, F.col("ptr") == F.col("_id")).select("id", "chain_id", F.col("_ptr").alias("ptr"), (F.col("hops") + F.col("_h")).alias("hops"))
        after = cut(cur.where("ptr IS NULL").unionByName(more))
        now = after.where("ptr IS NOT NULL").count()
        cur = after
        if now == left:  # only loops are left
            break
        left = now
    return cur.where("ptr IS NULL").select("chain_id", "id", F.col("hops").cast("long").alias("position"))


def relink(positions: DataFrame) -> DataFrame:
    """(chain_id, id, position, prev_id, next_id) from positions: numbered from 0 without holes."""
    w = Window.partitionBy("chain_id").orderBy("position", "id")
    return positions.select("chain_id", "id", (F.row_number().over(w) - 1).cast("long").alias("position"), F.lag("id").over(w).alias("prev_id"), F.lead("id").over(w).alias("next_id"))


def insert_node(positions: DataFrame, chain: int, node: int, before: int | None = None, after: int | None = None) -> DataFrame:
    """The chain with a node put before or behind another, or at the end; unknown neighbours put it at the end."""
    at = positions.where(F.col("chain_id") == chain).agg(F.max(F.when(F.col("id") == (before if before is not None else after), F.col("position"))).alias("p"), F.max("position").alias("last"))
    shift = -0.5 if before is not None else 0.5
    row = at.select(F.lit(chain).cast("long").alias("chain_id"), F.lit(node).cast("long").alias("id"), F.coalesce(F.col("p") + shift, F.col("last") + 1.0, F.lit(0.0)).alias("position"))
    return relink(positions.withColumn("position", F.col("position").cast("double")).unionByName(row))


def delete_nodes(positions: DataFrame, gone: DataFrame) -> DataFrame:
    """The chains without these ids, relinked."""
    return relink(positions.join(gone.select("id"), "id", "left_anti").select("chain_id", "id", "position"))


ALLOWED_UPDATES = ("file_path", "file_size", "file_hash", "metadata_json")


def update_nodes(nodes: DataFrame, updates: DataFrame) -> DataFrame:
    """Nodes with new values of the four columns that may change; nulls keep the old value and unknown ids do nothing."""
    u = updates.groupBy("id").agg(*[F.max(c).alias(f"_{c}") for c in ALLOWED_UPDATES if c in updates.columns])
    out = nodes.join(u, "id", "left")
    for c in ALLOWED_UPDATES:
        if f"_{c}" in out.columns:
            out = out.withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return out.select(*nodes.columns)


def replace_hashes(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Page hashes with those of the given nodes replaced."""
    return stored.join(new.select("node_id").distinct(), "node_id", "left_anti").unionByName(new)


def hash_pages(hashes: DataFrame) -> DataFrame:
    """(node_id, page_num, page_hash): one row per page, numbered from 0 without holes; null hashes are no pages."""
    one = hashes.where("page_hash IS NOT NULL AND node_id IS NOT NULL").groupBy("node_id", "page_num").agg(F.min("page_hash").alias("page_hash"))
    w = Window.partitionBy("node_id").orderBy("page_num")
    return one.select("node_id", (F.row_number().over(w) - 1).alias("page_num"), "page_hash")


def contained(pages: DataFrame) -> DataFrame:
    """(small_id, big_id, start_page): every place where one file's whole page sequence stands in another's.

    Only a small file's rarest page is joined, so pages that many files share don't multiply; the alignments it proposes
    are then counted page by page. Files with equal sequences contain each other.
    """
    pages = cut(pages)
    freq = pages.groupBy("page_hash").agg(F.count(F.lit(1)).alias("f"))
    w = Window.partitionBy("node_id")
    length = pages.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"))
    rare = pages.join(freq, "page_hash").groupBy("node_id").agg(F.min_by(F.struct("page_num", "page_hash"), F.struct("f", "page_hash", "page_num")).alias("r"))
    probe = rare.select(F.col("node_id").alias("small_id"), F.col("r.page_num").alias("at"), F.col("r.page_hash").alias("page_hash")).join(length.withColumnRenamed("node_id", "small_id"), "small_id")
    big = pages.select(F.col("node_id").alias("big_id"), F.col("page_num").alias("bp"), "page_hash").join(length.select(F.col("node_id").alias("big_id"), F.col("n").alias("bn")), "big_id")
    starts = probe.join(big, "page_hash").where("small_id <> big_id AND bp >= at AND bp - at + n <= bn").select("small_id", "big_id", (F.col("bp") - F.col("at")).alias("start_page"), "n")
    small = pages.select(F.col("node_id").alias("small_id"), F.col("page_num").alias("sp"), "page_hash")
    want = starts.join(small, "small_id").withColumn("bp", F.col("sp") + F.col("start_page"))
    got = want.join(pages.select(F.col("node_id").alias("big_id"), F.col("page_num").alias("bp"), F.col("page_hash").alias("bh")), ["big_id", "bp"]).where("page_hash = bh")
    return got.groupBy("small_id", "big_id", "start_page", "n").agg(F.count(F.lit(1)).alias("hits")).where("hits = n").select("small_id", "big_id", "start_page")


def gapped_subsequence(pages: DataFrame, pairs: DataFrame) -> DataFrame:
    """(small_id, big_id, is_subsequence) for given pairs: all of small's pages in order in big, gaps allowed.

    An empty sequence lies in every other. Greedy from the left: each page takes the first place behind the last.
    """
    seq = pages.groupBy("node_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "page_hash"))), lambda x: x["page_hash"]).alias("s"))
    empty = F.array().cast("array<string>")
    j = pairs.join(seq.select(F.col("node_id").alias("small_id"), F.col("s").alias("a")), "small_id", "left").join(seq.select(F.col("node_id").alias("big_id"), F.col("s").alias("b")), "big_id", "left")
    a, b = F.coalesce("a", empty), F.coalesce("b", empty)
    used = F.aggregate(b, F.lit(0), lambda k, h: F.when(F.get(a, k) == h, k + 1).otherwise(k))
    return j.select("small_id", "big_id", (used == F.size(a)).alias("is_subsequence"))


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_pages"), F.max("page_num").alias("last_page"))


def duplicates_by_hash(nodes: DataFrame) -> DataFrame:
    """(file_hash, id, duplicate_of): files whose hash an earlier id has; null hashes equal nothing."""
    n = nodes.select("id", "file_hash").distinct().where("file_hash IS NOT NULL")
    w = Window.partitionBy("file_hash")
    return n.withColumn("duplicate_of", F.min("id").over(w)).where("id <> duplicate_of").select("file_hash", "id", "duplicate_of")


def containment_duplicates(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(small_id, big_id) with small a part of big; of equally long files only the higher id is the duplicate."""
    c = counts.select("node_id", "n_pages")
    f = found.select("small_id", "big_id").distinct().join(c.select(F.col("node_id").alias("small_id"), F.col("n_pages").alias("sn")), "small_id").join(c.select(F.col("node_id").alias("big_id"), F.col("n_pages").alias("bn")), "big_id")
    return f.where("sn < bn OR small_id > big_id").select("small_id", "big_id")


def canonical_files(nodes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Nodes whose path is no duplicate's name; null names in the ledger mean nothing."""
    return nodes.join(ledger.where("file_name IS NOT NULL").select(F.col("file_name").alias("file_path")), "file_path", "left_anti")


def non_duplicates_null_aware(nodes: DataFrame, ledger: DataFrame) -> DataFrame:
    """NOT IN as SQL has it: one null hash in the ledger leaves nothing, and a node's own null hash is never sure to be absent.

    An anti join on the hash and one row that says what the ledger holds, so no side of it has to fit a broadcast.
    """
    held = ledger.agg((F.count(F.lit(1)) > 0).alias("_any"), F.coalesce(F.bool_or(F.col("file_hash").isNull()), F.lit(False)).alias("_null"))
    kept = nodes.join(ledger.where("file_hash IS NOT NULL").select("file_hash").distinct(), "file_hash", "left_anti")
    return kept.join(F.broadcast(held)).where(~F.col("_any") | (~F.col("_null") & F.col("file_hash").isNotNull())).drop("_any", "_null").select(*nodes.columns)  # one row


def chain_list(positions: DataFrame) -> DataFrame:
    """(chain_id, n_nodes, head_id, tail_id) of every chain."""
    return positions.groupBy("chain_id").agg(F.count(F.lit(1)).alias("n_nodes"), F.min_by("id", F.struct("position", "id")).alias("head_id"), F.max_by("id", F.struct("position", "id")).alias("tail_id"))


def delete_chains(nodes: DataFrame, gone: DataFrame) -> DataFrame:
    """The nodes without those of the chains; their page hashes stay where they are."""
    return nodes.join(gone.select("chain_id").distinct(), "chain_id", "left_anti")


def apply_additions(chains: DataFrame, additions: DataFrame) -> DataFrame:
    """(chain_id, file_path, position) after the additions (seq, file_path, prev, next) to chains of the same form.

    A file goes behind ``prev``, else before ``next``; without both it begins a chain of its own, numbered on from the highest.
    Names stand for the first place that has them. A file may lean on one added with it; files whose neighbour never turns up are
    left out. Of several files at one place the earlier stands nearer to the neighbour.
    """
    from .session import within

    start = chains.agg(F.coalesce(F.max("chain_id"), F.lit(0)).alias("_top"))
    own = additions.where("prev IS NULL AND next IS NULL").withColumn("_one", F.lit(1))
    own = within(own, "_one", ["seq"], "_n").join(F.broadcast(start)).select((F.col("_top") + 1 + F.col("_n")).alias("chain_id"), "file_path", F.lit(0).cast("long").alias("position"))  # one row
    now = cut(chains.select("chain_id", "file_path", F.col("position").cast("long").alias("position")).unionByName(own))
    rest = cut(additions.where("prev IS NOT NULL OR next IS NOT NULL"))
    while rest.limit(1).count():
        place = now.groupBy(F.col("file_path").alias("_at")).agg(F.min(F.struct("chain_id", "position")).alias("_p"))
        got = cut(rest.join(place, F.coalesce("prev", "next") == F.col("_at")))
        if not got.limit(1).count():
            break
        after = F.col("prev").isNotNull()
        # places between two old ones: behind one in the order of arrival, before one in the order against it
        new = got.select(F.col("_p.chain_id").alias("chain_id"), "file_path", F.col("_p.position").alias("position"), F.when(after, 2).otherwise(0).alias("_side"), F.col("seq").alias("_seq"))
        both = now.withColumns({"_side": F.lit(1), "_seq": F.lit(0).cast("long")}).unionByName(new.withColumn("_seq", F.col("_seq").cast("long")))
        now = cut(within(both, "chain_id", ["position", "_side", "_seq", "file_path"], "_n").select("chain_id", "file_path", F.col("_n").alias("position")))
        rest = cut(rest.join(got.select("seq"), "seq", "left_anti"))
    return now


def backfill(nodes: DataFrame, stored: DataFrame, hook, suffix: str = ".pdf") -> DataFrame:
    """Page hashes with those of the files that have none yet, as ``hook`` computes them for (node_id, file_path): PDF files only."""
    missing = nodes.where(F.lower("file_path").endswith(suffix)).select(F.col("id").alias("node_id"), "file_path").distinct().join(stored.select("node_id"), "node_id", "left_anti")
    return replace_hashes(stored, hook(missing).select(*stored.columns))


def folder_versions(files: DataFrame) -> DataFrame:
    """(path, name, suffix, size, modified, file_hash) of rows as the binaryFile reader gives them."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("suffix"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("file_hash"))
