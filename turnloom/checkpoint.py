"""Cutting lineage by reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a local session without one gets a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df by a reliable checkpoint in the shared folder, so that what follows is planned from its rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
