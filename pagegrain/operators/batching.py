"""Greedy batches under a token budget: an order-dependent fold, one group at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

START, EACH, BUDGET, ITEMS = 450, 15, 13_500, 25


def pack(tokens: list[int], budget: int | None, items: int | None) -> list[int]:
    """Batch number of each item: a batch closes before the item that would exceed a limit; one oversized item is alone.

    Without any limit, 25 items make a batch.
    """
    if budget is None and items is None:
        items = ITEMS
    out, batch, used, n = [], 0, START, 0
    for t in tokens:
        if n and ((budget is not None and used + t + EACH > budget) or (items is not None and n >= items)):
            batch, used, n = batch + 1, START, 0
        used, n = used + t + EACH, n + 1
        out.append(batch)
    return out


def greedy_batches(df: DataFrame, group: str, order: str, tokens: str, budget: int | None = BUDGET, items: int | None = None) -> DataFrame:
    """(group, order, tokens, batch). Rows stream through in order, so a group is never held whole."""
    kinds = dict(df.dtypes)
    schema = f"{group} {kinds[group]}, {order} {kinds[order]}, {tokens} long, batch int"
    limit = ITEMS if budget is None and items is None else items

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, batch, used, n = None, 0, START, 0
        for p in parts:
            out = []
            for g, t in zip(p[group], p[tokens]):
                if g != now:
                    now, batch, used, n = g, 0, START, 0
                elif n and ((budget is not None and used + t + EACH > budget) or (limit is not None and n >= limit)):
                    batch, used, n = batch + 1, START, 0
                used, n = used + t + EACH, n + 1
                out.append(batch)
            yield p.assign(batch=out)

    rows = df.select(group, order, F.col(tokens).cast("long").alias(tokens)).where(F.col(group).isNotNull())
    return rows.repartition(group).sortWithinPartitions(group, order).mapInPandas(run, schema)


def index_entries(nodes: DataFrame, keywords: int = 12, title: int = 120) -> DataFrame:
    """(node_id, title, keywords, tokens): what an index holds of a node, cut to its limits."""
    words = F.filter(F.split(F.lower(F.coalesce("title", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 2)
    return nodes.select("node_id", F.substring(F.coalesce("title", F.lit("")), 1, title).alias("title"), F.slice(F.array_distinct(words), 1, keywords).alias("keywords"), X.token_estimate("title").alias("tokens"))


def short_ids(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds short_id: nid:<number>:<title>, numbered per group in the order given."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(*order)
    return nodes.withColumn("short_id", F.concat(F.lit("nid:"), F.row_number().over(w).cast("string"), F.lit(":"), F.coalesce("title", F.lit(""))))
