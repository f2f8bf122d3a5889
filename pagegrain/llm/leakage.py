"""Passages of held-out items inside documents, by greedy string tiling.

Items and documents share tokens in runs: every ``k`` consecutive words of an item are a seed, and documents are searched
for seeds by the rolling (Karp-Rabin) hash of their own words, in one pass over the corpus for any number of items: what
can't be a seed is dropped by a bit filter of bounded size, and the rest is joined by hash. Seeds of an item and a document
that follow each other on one diagonal are one match; tiling marks the longest match that is not marked yet, again and again
down to ``k`` words; so moved passages are covered piece by piece, and the covered share of the item tells a passage that was
cut up and put in another order from a chance phrase. Each document is read whole.

Null and empty texts hold nothing; items of fewer than ``k`` words can't be searched for, which the report says;
repeated rows give the same row once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bitfilter
from ..functions.textvec import Words, chunks, signed
from ..session import cut

_U = np.uint64


def tile(p: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds: (item position, document position, length), longest first.

    p and q are the places of all shared seeds of ``k`` words. Of matches of one length the earliest in the item, then
    in the document, is marked; marked words match no more, so what is left of a match that lost words is tried again.
    """
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (np.diff(q) != 1)]))
    size = np.diff(np.append(new, len(p))) + (k - 1)
    low_p, low_q = int(p.min()), int(q.min())
    used_i, used_d = np.zeros(int(p.max()) + k - low_p, np.bool_), np.zeros(int(q.max()) + k - low_q, np.bool_)
    todo = [(-n, a, b) for n, a, b in zip(size.tolist(), p[new].tolist(), q[new].tolist())]
    heapq.heapify(todo)
    tiles = []
    while todo:
        n, a, b = heapq.heappop(todo)
        n = -n
        i, d = used_i[a - low_p : a - low_p + n], used_d[b - low_q : b - low_q + n]
        used = i | d
        if not used.any():
            i[:] = True
            d[:] = True
            tiles.append((a, b, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]]).astype(np.int8)))
        for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            if e - s >= k:
                heapq.heappush(todo, (s - e, a + s, b + s))
    return tiles


def _seeds(df: DataFrame, key: str, k: int, sent=None) -> DataFrame:
    """(key, h, g, at): the seeds of each text with their places, h telling texts of one key apart; with ``sent`` only those that may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                w = Words(part.column("text").to_pylist())
                first, g = w.grams(k)
                if sent is not None:
                    hit = bitfilter.probe(sent.value, g)
                    first, g = first[hit], g[hit]
                doc = w.doc[first]
                row = pa.array(doc)
                yield pa.RecordBatch.from_arrays([part.column(key).take(row), part.column("h").take(row), pa.array(signed(g)), pa.array((first - w.first[doc]).astype(np.int32))], [key, "h", "g", "at"])

    rows = df.where(F.col("text").isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, f"{key} long, h long, g long, at int")


def item_sizes(items: DataFrame) -> DataFrame:
    """(item_id, item_h, item_words) of the distinct texts of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Words(batch.column("text").to_pylist()).counts()
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item_h"), pa.array(n.astype(np.int64))], ["item_id", "item_h", "item_words"])

    rows = items.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_h"), "text").distinct()
    return rows.mapInArrow(run, "item_id long, item_h long, item_words long")


def leaked(documents: DataFrame, items: DataFrame, k: int = 5, longest: int = 10, coverage: float = 0.8) -> DataFrame:
    """(doc_id, item_id, item_words, covered_words, n_tiles, longest) of the documents that hold ``longest`` consecutive words of an item, or tiles that cover at least ``coverage`` of it."""
    seeds = cut(_seeds(items.select("item_id", "text").distinct(), "item_id", k))
    sent = documents.sparkSession.sparkContext.broadcast(bitfilter.build(seeds.select("g").distinct(), "g"))
    own = seeds.select("item_id", F.col("h").alias("item_h"), "g", F.col("at").alias("p"))
    met = _seeds(documents.select("doc_id", "text"), "doc_id", k, sent).join(own, "g")
    each = met.groupBy("doc_id", "h", "item_id", "item_h").agg(F.collect_set(F.struct("p", F.col("at").alias("q"))).alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column("s")
            off = s.offsets.to_numpy()
            flat = s.values.flatten()
            p, q = (x.to_numpy() for x in flat)
            out = [tile(p[a:b], q[a:b], k) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            stats = [[sum(t[2] for t in x) for x in out], [len(x) for x in out], [x[0][2] for x in out]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "item_id", "item_h")), *(pa.array(x, pa.int64()) for x in stats)], ["doc_id", "item_id", "item_h", "covered_words", "n_tiles", "longest"])

    tiled = each.select("doc_id", "item_id", "item_h", "s").mapInArrow(run, "doc_id long, item_id long, item_h long, covered_words long, n_tiles long, longest long")
    rows = tiled.join(item_sizes(items), ["item_id", "item_h"]).where((F.col("longest") >= longest) | (F.col("covered_words") >= F.col("item_words") * coverage))
    return rows.select("doc_id", "item_id", "item_words", "covered_words", "n_tiles", "longest").distinct()


def leak_report(found: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """Per item: in how many documents it was found, the largest share of its words that one of them holds, and whether it was long enough to be searched for."""
    per = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max(F.col("covered_words") / F.col("item_words")).alias("max_share"))
    size = item_sizes(items).groupBy("item_id").agg(F.max("item_words").alias("_n"))
    j = items.select("item_id", "suite").distinct().join(size, "item_id", "left").join(per, "item_id", "left")
    return j.select("item_id", "suite", (F.coalesce("_n", F.lit(0)) >= k).alias("searchable"), F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), F.coalesce("max_share", F.lit(0.0)).alias("max_share"))
