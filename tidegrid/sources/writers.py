"""Sinks: partitioned tables, small sorted tables, CSV, metrics and roles as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: str, files_per_value: int = 1) -> None:
    """Overwrite a Parquet table partitioned by a derived column.

    Rows are spread over ``files_per_value`` writers per partition value, so a month holding a
    third of the feed is not written by one task; left at 1 the write stays where the scan
    tasks are and shuffles nothing.
    """
    if files_per_value > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(F.col(by), salt)
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], single_file: bool = False) -> None:
    """Overwrite a Parquet table in key order.

    ``single_file`` is for grid-sized outputs only; otherwise the range-partitioned sort keeps
    one file per range and every file is sorted.
    """
    ordered = df.orderBy(*keys)
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").parquet(path)


REPORT_ROWS = 1_000_000


def report(df: DataFrame, most: int = REPORT_ROWS) -> DataFrame:
    """The frame in one partition; an error if it has more rows than a report may have."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"a report of one file holds at most {most} rows")
    return df.coalesce(1)


def write_csv(df: DataFrame, path: str) -> None:
    """A small report (counts, summaries) as one CSV file with a header."""
    report(df).write.mode("overwrite").csv(path, header=True)


def metric_rows(df: DataFrame, metrics: Mapping[str, object]) -> DataFrame:
    """Aggregate a frame into ``(metric, value)`` rows in one pass."""
    names = list(metrics)
    row = df.agg(*[metrics[name].cast("double").alias(name) for name in names])
    return row.unpivot([], names, "metric", "value")


def write_metrics(df: DataFrame, path: str) -> None:
    report(df).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str = "metric string, value double") -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_roles(roles: DataFrame, path: str) -> None:
    report(roles).write.mode("overwrite").json(path)


def read_roles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "column_name string, role string, feature_group string, position int"
    ).json(path)
