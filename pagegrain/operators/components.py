"""Connected components of an edge table by alternating star contraction; every round is a join or aggregate on ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def components(edges: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """(id, component): the smallest id that each endpoint reaches. An empty table gives none.

    Each round links every id's larger neighbours to its smallest one and then every id's smaller ones; edges only
    shrink, hot ids are min-aggregated before the shuffle, and the rounds grow with the logarithm of the size.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    ids = e.select(F.col("u").alias("id")).union(e.select("v")).distinct()
    e = cut(e)
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return ids.join(e.select(F.col("u").alias("id"), F.col("v").alias("m")), "id", "left").select("id", F.coalesce("m", "id").alias("component"))
