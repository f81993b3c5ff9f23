"""Cutting lineage in the session's shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, that of ``spark.checkpoint.dir``, which a session must name."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def few(rows: DataFrame, most: int = 200_000) -> DataFrame:
    """Cut rows, marked for broadcast if counted to be few; else Spark shuffles."""
    rows = cut(rows)
    return F.broadcast(rows) if rows.count() <= most else rows


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what is cut and no longer named; else they stay until its driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
