"""Session builder: only settings that hold on a laptop and on a large cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster sizing stays with the cluster.

    Shuffle partitions are left to the caller: adaptive execution coalesces a generous
    number down, but cannot raise a small one.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
