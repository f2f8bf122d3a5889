"""Consecutive numbers for the values of a column, without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def numbered(df: DataFrame, order: str | list[str], name: str = "n") -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... in the order of the columns; rows equal in all of them come in any order.

    A range partition's own count is added to the counts before it; of these there is one row a partition.
    """
    by = [order] if isinstance(order, str) else order
    ranged = cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_p", F.spark_partition_id()))
    per = ranged.groupBy("_p").count()
    base = per.select("_p", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*by))
    return ranged.withColumn(name, own.cast("long") - 1).join(F.broadcast(base), "_p").withColumn(name, F.col(name) + F.col("_base")).drop("_p", "_base")
