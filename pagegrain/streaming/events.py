"""Structured Streaming over the append-only logs: telemetry in, totals and attempts out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

EVENT_SCHEMA = (
    "id long, ts_iso string, document_id string, run_id string, parent_run_id string, event_name string, model_name string, "
    "filename string, line_number int, token_count int, cost_usd double, n_try double, metadata_json string"
)


def event_stream(spark: SparkSession, folder: str, fmt: str = "parquet", files_per_batch: int = 16) -> DataFrame:
    """The events of a growing folder."""
    return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(folder)


def windowed_usage(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events, tokens and cost per tumbling window and event name; rows later than ``late`` are dropped."""
    e = events.withColumn("ts", F.to_timestamp("ts_iso")).withWatermark("ts", late)
    g = e.groupBy(F.window("ts", window).alias("w"), "event_name").agg(F.count(F.lit(1)).alias("n_events"), F.sum("token_count").alias("tokens"), F.sum("cost_usd").alias("cost"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_name", "n_events", "tokens", "cost")


def usage_counts(events: DataFrame) -> DataFrame:
    """Running totals per event name."""
    return events.groupBy("event_name").agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("token_count").cast("long")).alias("tokens"))


def append_sink(df: DataFrame, path: str, checkpoint: str, every: str = "1 second"):
    """Append micro-batches to a parquet folder; the checkpoint resumes the query without repeating a batch."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).outputMode("append").start()


def drain(df: DataFrame, table: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Run everything that is there now through the query and give the result as a table, kept beside the checkpoint under the name.

    In complete mode each batch replaces the result, otherwise it is added to it; nothing passes through the driver.
    """
    path = f"{checkpoint}-{table}"
    write = lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path)
    empty = df.sparkSession.createDataFrame([], df.schema)
    empty.write.mode("append").parquet(path)  # a stream without a batch has an empty result
    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


class AttemptCounter(StatefulProcessor):
    """State per key: how many attempts so far; each row comes out with its attempt number."""

    def init(self, handle) -> None:
        self._n = handle.getValueState("n", "n int")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        n = self._n.get()[0] if self._n.exists() else 0
        for pdf in rows:
            pdf = pdf.sort_values("id")
            pdf["attempt"] = range(n + 1, n + 1 + len(pdf))
            n += len(pdf)
            yield pd.DataFrame({"run_id": pdf["run_id"], "id": pdf["id"], "attempt": pdf["attempt"].astype("int32")})
        self._n.update((n,))

    def close(self) -> None:
        pass


def attempts(events: DataFrame) -> DataFrame:
    """(run_id, id, attempt) by a custom stateful operator."""
    return events.select("run_id", "id").groupBy("run_id").transformWithStateInPandas(AttemptCounter(), outputStructType="run_id string, id long, attempt int", outputMode="Append", timeMode="None")
