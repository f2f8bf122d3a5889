"""Parquet tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """The table as stored, pruned to ``columns`` when any are named."""
    df = spark.read.parquet(f"{base}/{name}.parquet")
    return df.select(*columns) if columns else df
