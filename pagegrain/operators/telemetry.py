"""Telemetry of model calls: events, token cost, traces, and calls answered from a cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

# Price of 1,000 tokens in dollars as (input, output, cached input); what an unknown model costs.
PRICES = {
    "gemini-3-flash-preview": (0.0005, 0.003, 0.0),
    "gemini-3.0-pro": (0.002, 0.012, 0.00031),
    "gemini-2.0-flash": (0.0001, 0.0004, 0.0),
    "gemini-1.5-pro": (0.00125, 0.005, 0.0),
    "gemini-2.5-flash-preview-04-17": (0.00015, 0.0035, 0.0000375),
    "gemini-2.5-flash": (0.0003, 0.0025, 0.0000375),
    "gemini-2.5-pro-preview-03-25": (0.00125, 0.01, 0.00031),
    "gemini-2.5-pro": (0.00125, 0.01, 0.00031),
    "gemini-2.5-flash-lite": (0.0001, 0.004, 0.00025),
}
FALLBACK = (0.00000125, 0.000005, 0.0)


def model_key(model: Column | str) -> Column:
    """The model's name without the models/ prefix that some providers put before it."""
    return F.regexp_replace(F.col(model) if isinstance(model, str) else model, "^models/", "")


def price_table(spark: SparkSession, prices: dict | None = None) -> DataFrame:
    rows = [(k, *v) for k, v in (prices or PRICES).items()]
    return spark.createDataFrame(rows, "model string, p_in double, p_out double, p_cache double")


def with_cost(calls: DataFrame, prices: DataFrame, model: str = "model_name") -> DataFrame:
    """Adds cost and priced: (input - cached, not below 0) at the input price, the rest at theirs; per 1,000 tokens.

    Unknown and null models cost the fallback and are flagged. The price table has a row per model, so it is broadcast.
    """
    j = calls.withColumn("_m", model_key(model)).join(F.broadcast(prices.withColumnRenamed("model", "_m")), "_m", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    p = lambda c, i: F.coalesce(c, F.lit(FALLBACK[i]))
    cost = (F.greatest(z("input_tokens") - z("cached_tokens"), F.lit(0)) * p("p_in", 0) + z("cached_tokens") * p("p_cache", 2) + z("output_tokens") * p("p_out", 1)) / 1000
    return j.withColumns({"cost": cost, "priced": F.col("p_in").isNotNull()}).drop("_m", "p_in", "p_out", "p_cache")


def distinct_events(events: DataFrame) -> DataFrame:
    """Events that came under two ids, once: the lowest id of those that agree in all else."""
    cols = [c for c in events.columns if c != "id"]
    return events.groupBy(*cols).agg(F.min("id").alias("id")).select(*events.columns)


def event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.to_timestamp("ts_iso"))


def usage_totals(events: DataFrame, *by: str) -> DataFrame:
    """Calls, tokens, cost and errors per group. Cost is added up as a decimal, so the order of the rows doesn't show in it."""
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("event_name") == "llm_end").alias("n_calls"), F.count_if(F.col("event_name") == "llm_error").alias("n_errors"), F.sum("token_count").alias("tokens"), F.sum(F.col("cost_usd").cast("decimal(24,10)")).alias("cost")
    )


def run_trace(events: DataFrame) -> DataFrame:
    """(run_id, n_events, first_id, last_id, last_event): each run's latest checkpoint by id."""
    return events.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.max_by("event_name", "id").alias("last_event"))


def call_key(operation: str, *parts: str) -> Column:
    """The cache key of a call: the operation and its arguments as JSON with sorted names."""
    return X.stable_id("call", F.lit(operation), F.to_json(F.struct(*sorted(parts))))


def cached_calls(calls: DataFrame, cache: DataFrame, hook: Callable) -> tuple[DataFrame, DataFrame]:
    """(answers with hit, new cache rows). Only keys that the cache lacks reach the hook, each once; calls and cache have (key)."""
    known = cache.select("key", F.col("answer").alias("_a"))
    miss = calls.join(known.select("key"), "key", "left_anti").dropDuplicates(["key"])
    new = hook(miss).select("key", "answer")
    full = known.select("key", F.col("_a").alias("answer"), F.lit(True).alias("hit")).unionByName(new.withColumn("hit", F.lit(False)))
    return calls.join(full, "key", "left"), new
