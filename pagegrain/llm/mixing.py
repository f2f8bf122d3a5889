"""A mix of sources with target shares of all tokens, in shuffled shards.

Sizes are tokens of a public tokenizer. Each source supplies whole passes over its documents and one partial pass, cut
at its quota. Documents of a pass are dealt by hash into blocks; a multivariate-hypergeometric splitting tree halves the
shards again and again and draws how many of each source's blocks either half gets, so each shard has exact block
quotas and the whole is a uniform random split. Shards then take disjoint runs of each source's permuted blocks, and
documents are put in random order inside their shard. Only block counts per source reach the driver.

Documents with a null source, of a source without a target, or without tokens are not drawn; a source without documents
gets share 0, and the other targets are scaled up to 1. Empty targets give an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.textvec import chunks
from ..operators.numbering import numbered
from ..session import cut
from .repetition import _encoder, default_vocabulary


#: Most tokens of a shard, which one task shuffles; there are 64 shards at least.
SHARD_TOKENS = 10**9
#: Blocks whose sizes one window adds up.
RUN = 4096


def token_sizes(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens); null and empty texts have 0."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                n = [len(x) for x in enc.encode_ordinary_batch([t or "" for t in part.column("text").to_pylist()], num_threads=1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text").mapInArrow(run, "doc_id long, source string, n_tokens long")


def quotas(have: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens to draw from each source that exists.

    Without a total, the largest mix in which every existing source reaches its share within its repeats. With one,
    each source gets its share of it or all its repeats, whichever is less.
    """
    live = {s: (t, r) for s, (t, r) in targets.items() if have.get(s, 0) > 0 and t > 0 and r > 0}
    whole = sum(t for t, _ in live.values())
    if not live:
        return {}
    most = min(r * have[s] / (t / whole) for s, (t, r) in live.items())
    size = most if total is None else total
    return {s: min(int(size * t / whole), r * have[s]) for s, (t, r) in live.items()}


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from good + bad are good; exact for any size, while the library's own draw ends at 10**9.

    A larger draw is made in bulk: each of the population is taken with the same chance, which leaves a uniform random
    set of a size near ``draws``; the few too many or too few are put back or drawn in the same manner.
    """
    total = good + bad
    if total < 10**9:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    if 2 * draws > total:
        return good - hypergeometric(rng, good, bad, total - draws)
    taken = 0
    while draws > 1000:
        p = draws / (good + bad)
        x, y = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
        if x + y > draws:
            return taken + x - hypergeometric(rng, x, y, x + y - draws)
        taken, good, bad, draws = taken + x, good - x, bad - y, draws - x - y
    for _ in range(draws):
        hit = int(rng.integers(good + bad)) < good
        taken, good, bad = taken + hit, good - hit, bad - (not hit)
    return taken


def split_blocks(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """shards x sources: how many blocks of each source each shard gets. Columns add up to ``counts``."""
    out = np.zeros((shards, len(counts)), np.int64)

    def split(lo: int, hi: int, left: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = left
            return
        mid = (lo + hi) // 2
        total = int(left.sum())
        take = (total * (mid - lo) + (hi - lo) // 2) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        some, rest, need = np.zeros_like(left), total, take
        for i, n in enumerate(left.tolist()):  # source by source, each against all that follow
            rest -= n
            some[i] = hypergeometric(rng, n, rest, need)
            need -= int(some[i])
        split(lo, mid, some)
        split(mid, hi, left - some)

    split(0, shards, np.asarray(counts, np.int64))
    return out


def _unit(seed: int, salt: int) -> F.Column:
    """A number in [0, 1) from the document, the copy and the seed."""
    h = F.xxhash64(F.lit(seed), F.lit(salt), "doc_id", "copy")
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def mix(sizes: DataFrame, targets: DataFrame, shards: int | None = None, block_tokens: int = 16384, total: int | None = None, seed: int = 7) -> DataFrame:
    """(shard, pos, doc_id, source, copy, n_tokens): the drawn documents in their random order. ``targets`` has a row per source."""
    spark = sizes.sparkSession
    sizes = cut(sizes.where("n_tokens > 0 AND source IS NOT NULL").join(targets.select("source").distinct(), "source", "left_semi"))
    have = {r["source"]: r["n"] for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    want = quotas(have, {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.where("source IS NOT NULL").collect()}, total)
    if not want:
        return spark.createDataFrame([], "shard int, pos long, doc_id long, source string, copy int, n_tokens long")
    shards = shards or max(64, -(-sum(want.values()) // SHARD_TOKENS))
    plan = [(s, have[s], q, q // have[s], q - q // have[s] * have[s], max(1, math.ceil(have[s] / block_tokens))) for s, q in want.items()]
    p = F.broadcast(spark.createDataFrame(plan, "source string, have long, quota long, passes int, rest long, n_blocks long"))  # a row per source with a target
    each = sizes.join(p, "source").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1))))
    each = each.withColumn("u", _unit(seed, 1)).withColumn("block", F.floor(F.col("u") * F.col("n_blocks")))
    whole = each.where("copy < passes")
    part = each.where("copy = passes")
    # the partial pass: sizes of blocks, their running sum, and a running sum by document in the one block it ends in
    sums = part.groupBy("source", "block").agg(F.sum("n_tokens").alias("size"))
    # in two levels: blocks within a run of blocks, and the runs of a source
    run = sums.withColumn("_g", F.floor(F.col("block") / RUN))
    ahead = (Window.unboundedPreceding, -1)
    far = run.groupBy("source", "_g").agg(F.sum("size").alias("_s")).withColumn("_far", F.coalesce(F.sum("_s").over(Window.partitionBy("source").orderBy("_g").rowsBetween(*ahead)), F.lit(0))).drop("_s")
    near = F.coalesce(F.sum("size").over(Window.partitionBy("source", "_g").orderBy("block").rowsBetween(*ahead)), F.lit(0))
    run = run.withColumn("_near", near).join(far, ["source", "_g"]).select("source", "block", "size", (F.col("_near") + F.col("_far")).alias("before"))
    part = part.join(run, ["source", "block"]).where("before < rest")
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("u", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    last = part.where("before + size > rest").withColumn("upto", inside).where(F.col("before") + F.col("upto") - F.col("n_tokens") / 2 <= F.col("rest"))
    cols = ["source", "doc_id", "copy", "n_tokens", "block"]
    drawn = cut(whole.select(*cols).unionByName(part.where("before + size <= rest").select(*cols)).unionByName(last.select(*cols)))

    blocks = drawn.select("source", "copy", "block").distinct()
    counts = {r["source"]: r["count"] for r in blocks.groupBy("source").count().collect()}
    names = sorted(counts)
    share = split_blocks(np.array([counts[s] for s in names]), shards, seed)
    ends = {s: np.cumsum(share[:, i]) for i, s in enumerate(names)}  # shards x sources numbers, whatever the documents
    offset = dict(zip(names, np.concatenate([[0], np.cumsum([counts[s] for s in names])]).tolist()))
    order = blocks.withColumn("_h", F.xxhash64(F.lit(seed), "source", "copy", "block"))
    ranked = numbered(order, ["source", "_h", "copy", "block"], "nth")  # a source's blocks follow each other, from its offset on

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, n = b.column(0).to_pylist(), b.column(3).to_pylist()
            at = [int(np.searchsorted(ends[s], k - offset[s], side="right")) for s, k in zip(own, n)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(at, pa.int32())], ["source", "copy", "block", "shard"])

    placed = ranked.select("source", F.col("copy").cast("int").alias("copy"), F.col("block").cast("long").alias("block"), F.col("nth")).mapInArrow(place, "source string, copy int, block long, shard int")
    rows = drawn.join(placed, ["source", "copy", "block"])
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), F.lit(2), "doc_id", "copy"), "doc_id", "copy")
    return rows.select("shard", (F.row_number().over(order) - 1).cast("long").alias("pos"), "doc_id", "source", "copy", "n_tokens")


def mix_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: its share, tokens, documents and highest use of a document in the mix, and the share reached."""
    total = mixed.agg(F.sum("n_tokens").alias("all_tokens"))
    per = mixed.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"), (F.max("copy") + 1).alias("most_uses"))
    out = targets.select("source", "target_share", "max_repeats").join(per, "source", "left").join(F.broadcast(total))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("source", "target_share", "max_repeats", zero("n_tokens"), zero("n_docs"), zero("most_uses"), F.coalesce(F.col("n_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("reached_share"))
