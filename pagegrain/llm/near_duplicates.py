"""Sets whose Jaccard similarity reaches a threshold, by parity sketches.

Equal sets are one class from the start, so a third of all rows being copies of one text is one class with many members. A
set's tokens are XOR-hashed into the bits of a narrow sketch of 128 bits; differences can only cancel there, so the
sketches' Hamming distance never exceeds the size of the sets' symmetric difference, which a similarity of t bounds
by (1-t)/(1+t) * (|A|+|B|). The pigeonhole join is a prefix filter: a set of n tokens lacks at most n - ceil(t n) of a
similar set's that is no larger, and at most n - ceil(2t/(1+t) n) of one that is no smaller; so of one more than that many
tokens, the rarest in one order for all records, at least one is shared. These are joined, each pair is tested on its
sizes and sketches inside the join, and what is left is verified on the whole sets. No pair is lost and no bucket is
capped: tokens that many sets share come last in the order and are hardly ever joined on; where one is hot all the same,
its sets are split and the parts meet in all combinations, a task each. The order comes from a count sketch of fixed size.

Texts are tokenised three times (counts and classes, rare tokens, verification) and not stored in between: the
sets are larger than the compressed texts. Null and empty texts have no tokens and pair with nothing; repeated rows of one
id count once. Ties in the order are broken by hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bitfilter
from ..functions.textvec import Words, chunks, distinct_per_text, mix64, signed
from ..operators.components import components
from ..session import cut, spill

_U = np.uint64
BUCKETS = 1 << 20  # of the count sketch, which is all that is sent to every task: 4 bytes each
PARTS = 16
#: Sets that share one token in a task; of a token with more, the sets are split into parts of about so many.
HOT = 2000


def word_sets(df: DataFrame, key: str, text: str, k: int, min_words: int) -> DataFrame:
    """(id, toks): the set of ``k`` consecutive words of each text of at least ``min_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                w = Words(part.column(text).to_pylist())
                at, g = w.grams(k)
                d, h = distinct_per_text(w.doc[at], g)
                keep = np.flatnonzero(w.counts() >= min_words)
                lo, hi = np.searchsorted(d, keep), np.searchsorted(d, keep, side="right")
                lens = hi - lo
                idx = np.repeat(lo - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum()) if len(keep) else np.zeros(0, np.int64)
                toks = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(signed(h[idx])))
                yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(keep)), toks], ["id", "toks"])

    return df.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "id long, toks array<long>")


def char_sets(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(id, toks): the set of ``k`` consecutive characters of each lower-case text."""
    low = F.lower(text)
    grams = F.transform(F.sequence(F.lit(1), F.length(low) - (k - 1)), lambda i: F.xxhash64(F.substring(low, i, F.lit(k))))
    return df.where(F.length(text) >= k).select(F.col(key).cast("long").alias("id"), F.array_distinct(grams).alias("toks"))


def value_sets(df: DataFrame, key: str, value: str) -> DataFrame:
    """(id, toks): the set of non-null values of each key."""
    return df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(F.collect_set(F.xxhash64(value)).alias("toks"))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, sizes and the tokens end to end."""
    col = batch.column(batch.schema.get_field_index("toks"))
    off = col.offsets.to_numpy()
    toks = col.values.to_numpy()[off[0] : off[-1]] if len(off) > 1 else np.zeros(0, np.int64)
    return batch.column(batch.schema.get_field_index("id")).to_numpy(), np.diff(off), np.ascontiguousarray(toks).view(_U)


def _bucket(toks: np.ndarray) -> np.ndarray:
    return (mix64(toks) >> _U(44)).astype(np.int64)


def _classes(n: np.ndarray, toks: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers for each set, whatever the order of its tokens; sets may not be empty."""
    at = np.cumsum(n) - n
    return np.stack([mix64(np.add.reduceat(mix64(toks ^ _U(k)), at) + _U(k)) for k in (0x5BD1E9955BD1E995, 0xC2B2AE3D27D4EB4F)], 1)


def _keys(classes: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(16), len(classes), [None, pa.py_buffer(np.ascontiguousarray(classes).tobytes())]).cast(pa.binary())


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first number of each class."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int64)[0::2])], ["k"])


def _some(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_arrays`` without empty sets."""
    ids, n, toks = _arrays(batch)
    return ids[n > 0], n[n > 0], toks


def _surveyed(sets: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(id, c) of all records, c being the class of equal sets; and how many tokens fall into each bucket, over all records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        names = ["id", "c", "part"]
        for batch in batches:
            ids, n, toks = _some(batch)
            total += np.bincount(_bucket(toks), minlength=BUCKETS)
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array(ids), _keys(_classes(n, toks)), pa.nulls(len(n), pa.int32())], names)
        parts = [zlib.compress(p.tobytes(), 1) for p in np.split(total, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.nulls(PARTS, pa.int64()), pa.array(parts, pa.binary()), pa.array(range(PARTS), pa.int32())], names)

    def add(key, pdf):
        total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in pdf["c"])
        return pd.DataFrame({"part": [key[0]], "c": [zlib.compress(total.tobytes(), 1)]})

    seen = cut(sets.mapInArrow(run, "id long, c binary, part int"))
    got = seen.where("part IS NOT NULL").groupBy("part").applyInPandas(add, "part int, c binary").collect()  # PARTS rows
    by = {r["part"]: np.frombuffer(zlib.decompress(bytes(r["c"])), np.int64) for r in got}
    return seen.where("part IS NULL").select("id", "c").distinct(), np.concatenate([by.get(i, np.zeros(BUCKETS // PARTS, np.int64)) for i in range(PARTS)])


def _bits(sets: DataFrame, t: float, counts: np.ndarray, twins: DataFrame) -> DataFrame:
    """(bit, id, n, f0, f1, inner): the rarest tokens of each class under its representative's id, its size and sketch.

    inner marks the tokens by which a set is found by those no smaller than itself. Rows that may come from a class with
    several members, which a bit filter tells, carry their class and are brought under the representative; the others, as a rule
    nearly all, stand for themselves.
    """
    sent = sets.sparkSession.sparkContext.broadcast((np.minimum(counts, 2**31 - 1).astype(np.int32), bitfilter.build(cut(twins.select("c").distinct().mapInArrow(_firsts, "k long")), "k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, toks = _some(batch)
            if not len(toks):
                continue
            cls = _classes(n, toks)
            first = np.unique(cls.view("u8,u8").ravel(), return_index=True)[1]  # equal sets of a batch go out once
            if len(first) < len(n):
                lo = (np.cumsum(n) - n)[first]
                n, cls, ids = n[first], cls[first], ids[first]
                toks = toks[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            rec = np.repeat(np.arange(len(n)), n)
            h = mix64(toks ^ _U(0xA5A5A5A5A5A5A5A5))
            odd = np.bincount(rec * 128 + (h & _U(127)).astype(np.int64), minlength=len(n) * 128) & 1
            fold = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(n), 2)
            outer = n - np.ceil(t * n - 1e-9).astype(np.int64) + 1
            inner = n - np.ceil(2 * t / (1 + t) * n - 1e-9).astype(np.int64) + 1
            order = np.lexsort((h, sent.value[0][_bucket(toks)], rec))
            rank = np.arange(len(order)) - (np.cumsum(n) - n)[rec[order]]
            keep = order[rank < outer[rec[order]]]
            rank = rank[rank < outer[rec[order]]]
            own = rec[keep]
            twin = bitfilter.probe(sent.value[1], cls[:, 0])
            cls = _keys(cls).take(pa.array(np.arange(len(n)), mask=~twin)).take(pa.array(own))
            cols = [pa.array(signed(toks[keep])), pa.array(ids[own]), cls, *(pa.array(x) for x in (n[own].astype(np.int32), fold[own, 0], fold[own, 1], rank < inner[own]))]
            yield pa.RecordBatch.from_arrays(cols, ["bit", "id", "c", "n", "f0", "f1", "inner"])

    held = spill(sets.mapInArrow(run, "bit long, id long, c binary, n int, f0 long, f1 long, inner boolean"))
    rep = twins.groupBy("c").agg(F.min("id").alias("_rep"))
    some = held.where("c IS NOT NULL").join(rep, "c", "left").withColumn("id", F.coalesce("_rep", "id")).drop("c", "_rep").distinct()
    return held.where("c IS NULL").drop("c").unionByName(some)


def _only(sets: DataFrame, need: DataFrame) -> DataFrame:
    """(id, toks) of the needed records; what can't be needed is dropped before anything is shuffled."""
    sent = sets.sparkSession.sparkContext.broadcast(bitfilter.build(need, "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy().view(_U)
            yield batch.filter(pa.array(bitfilter.probe(sent.value, ids)))

    return sets.select("id", "toks").mapInArrow(run, "id long, toks array<long>").join(need, "id", "left_semi").dropDuplicates(["id"])


def _met(bits: DataFrame, t: float) -> DataFrame:
    """Pairs of ids that share a bit and pass the tests of size and sketch.

    Bits with a column s are hot: their sets fall into s parts, and each pair of parts meets in a task of its own.
    """
    cols, on, left, right = ["id", "n", "f0", "f1"], ["bit"], bits, bits.where("inner")
    if "s" in bits.columns:
        own, each = F.pmod(F.xxhash64("id"), F.col("s")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("s") - 1))
        on, left, right = ["bit", "i", "j"], left.withColumns({"i": own, "j": each}), right.withColumns({"j": own, "i": each})
    side = lambda d, p: d.select(*on, *[F.col(x).alias(f"{p}_{x}") for x in cols])
    first = (F.col("r_n") < F.col("l_n")) | ((F.col("r_n") == F.col("l_n")) & (F.col("r_id") < F.col("l_id")))
    near = F.col("r_n") >= F.col("l_n") * F.lit(t) - 1e-9
    apart = F.bit_count(F.col("l_f0").bitwiseXOR(F.col("r_f0"))) + F.bit_count(F.col("l_f1").bitwiseXOR(F.col("r_f1")))
    alike = apart <= (F.col("l_n") + F.col("r_n")) * F.lit((1 - t) / (1 + t)) + 1e-9
    return side(left, "l").join(side(right, "r"), on).where(first & near & alike & (F.col("l_id") != F.col("r_id"))).select("l_id", "r_id")


def class_pairs(sets: DataFrame, t: float) -> tuple[DataFrame, DataFrame]:
    """(twins, pairs): (id, rep) of the records whose set others have too, rep being the smallest of these; and
    (id_a, id_b, similarity), id_a < id_b, of all similar sets of (id, toks), each under its rep or, where it has none, its id."""
    members, counts = _surveyed(sets)
    several = members.groupBy("c").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("k")).where("k > 1").select("c", "rep")
    twins = cut(members.join(several, "c"))
    bits = _bits(sets, t, counts, twins)
    hot = cut(bits.groupBy("bit").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HOT).select("bit", F.ceil(F.col("k") / HOT).cast("int").alias("s")))
    met = _met(bits, t)
    if hot.limit(1).count():
        met = _met(bits.join(hot, "bit", "left_anti"), t).unionByName(_met(bits.join(hot, "bit"), t))
    found = cut(met.select(F.least("l_id", "r_id").alias("id_a"), F.greatest("l_id", "r_id").alias("id_b")).distinct())
    need = cut(found.select(F.col("id_a").alias("id")).union(found.select("id_b")).distinct())
    held = spill(_only(sets, need))
    a, b = (held.select(F.col("id").alias(f"id_{s}"), F.col("toks").alias(f"t_{s}")) for s in "ab")
    both = found.join(a, "id_a").join(b, "id_b").withColumn("_i", F.size(F.array_intersect("t_a", "t_b")))
    sim = F.col("_i") / (F.size("t_a") + F.size("t_b") - F.col("_i"))
    return twins.select("id", "rep"), both.select("id_a", "id_b", sim.alias("similarity")).where(F.col("similarity") >= t)


def similar_pairs(sets: DataFrame, t: float) -> DataFrame:
    """(id_a, id_b, similarity), id_a < id_b: the pairs of records of ``class_pairs``, those of equal sets included.

    A class of k records alone gives k(k-1)/2 rows: where that is too much, take ``class_pairs`` or ``similarity_groups``.
    """
    twins, pairs = class_pairs(sets, t)
    own = lambda s: twins.select(F.col("rep").alias(f"id_{s}"), F.col("id").alias(f"m_{s}"))
    across = pairs.join(own("a"), "id_a", "left").join(own("b"), "id_b", "left").select(F.coalesce("m_a", "id_a").alias("x"), F.coalesce("m_b", "id_b").alias("y"), "similarity")
    within = own("a").select(F.col("id_a").alias("rep"), F.col("m_a").alias("x")).join(own("b").select(F.col("id_b").alias("rep"), F.col("m_b").alias("y")), "rep").where("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    return across.unionByName(within).where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def similarity_groups(sets: DataFrame, t: float) -> DataFrame:
    """(id, group_id, n_links): one row per id with the smallest id its links reach; without a similar record an id is its own group.

    Links are counted over classes: a record has its class's other members and all members of the similar classes. Ids
    without tokens have none.
    """
    twins, pairs = class_pairs(sets, t)
    pairs = cut(pairs)
    size = twins.groupBy(F.col("rep").alias("id")).agg(F.count(F.lit(1)).alias("size"))
    ends = pairs.select("id_a", "id_b").union(pairs.select("id_b", "id_a")).toDF("rep", "other")
    across = ends.join(size.select(F.col("id").alias("other"), "size"), "other", "left").groupBy("rep").agg(F.sum(F.coalesce("size", F.lit(1))).alias("across"))
    comp = components(pairs).select(F.col("id").alias("rep"), "component")
    own = sets.select("id").distinct().join(twins, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    own = own.join(size.select(F.col("id").alias("rep"), "size"), "rep", "left").join(across, "rep", "left").join(comp, "rep", "left")
    links = F.coalesce("size", F.lit(1)) - 1 + F.coalesce("across", F.lit(0))
    return own.select("id", F.coalesce("component", "rep").alias("group_id"), links.cast("long").alias("n_links"))


KINDS = {"cluster": 0.7, "pages": 0.6, "path": 0.7}


def record_sets(kind: str, clusters: DataFrame, nodes: DataFrame, page_hashes: DataFrame) -> DataFrame:
    """The sets that records of a kind are compared by: three words, page hashes, or three characters of the path."""
    if kind == "cluster":
        return word_sets(clusters, "cluster_uid", "text", 3, 24)
    if kind == "pages":
        return value_sets(page_hashes, "node_id", "page_hash").join(nodes.select(F.col("id").cast("long").alias("id")).distinct(), "id", "left_semi")
    return char_sets(nodes.select("id", "file_path").distinct(), "id", "file_path", 3)


def near_duplicate_records(clusters: DataFrame, nodes: DataFrame, page_hashes: DataFrame) -> DataFrame:
    """(record_kind, id_a, id_b) over all three kinds of records."""
    out = None
    for kind, t in KINDS.items():
        part = similar_pairs(record_sets(kind, clusters, nodes, page_hashes), t).select(F.lit(kind).alias("record_kind"), "id_a", "id_b")
        out = part if out is None else out.unionByName(part)
    return out
