"""Session helpers: lineage cuts in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that names none and runs inside one machine gets a temporary folder; on a
    cluster without a shared folder this raises, since a machine-local one would lose data.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pagegrain-")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage and forget how it was made."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spill(df: DataFrame) -> DataFrame:
    """Like ``cut``, for large tables: written as compressed columns, a table in the same folder."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
