"""Cutting lineage in a place that every executor can read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's ``spark.checkpoint.dir``; on a local master only, fall back to one.

    A cluster without the setting is an error: a folder on one machine is lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tidegrid-checkpoint-")
    context.setCheckpointDir(configured)


def stage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise a frame that is read many times, so that later plans start from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
