"""Month partitions, required months and coverage against an expected grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_partitions(spark: SparkSession, start: str, end: str, lead: int = 1) -> DataFrame:
    """One row per month of ``[start, end)`` plus ``lead`` months before it.

    ``month`` is ``yyyy-MM``; ``month_start`` and ``month_end`` are half-open bounds.
    """
    first = F.add_months(F.trunc(F.lit(start).cast("date"), "month"), -lead)
    last = F.trunc(F.date_sub(F.lit(end).cast("date"), 1), "month")
    months = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month_start")
    )
    return months.select(
        F.date_format("month_start", "yyyy-MM").alias("month"),
        "month_start",
        F.add_months("month_start", 1).alias("month_end"),
        (F.col("month_start") < F.trunc(F.lit(start).cast("date"), "month")).alias("is_lead"),
    )


def missing_months(present: DataFrame, required: DataFrame, month: str = "month") -> DataFrame:
    """Required months with no row in ``present``."""
    return required.join(present.select(month).distinct(), on=month, how="left_anti")


def require_months(present: DataFrame, required: DataFrame, month: str = "month") -> None:
    """Fail when a required month is absent from the feed."""
    gap = missing_months(present, required, month)
    if not gap.isEmpty():
        raise ValueError("required months are missing from the feed")


def coverage_report(
    df: DataFrame, by: Sequence[str], hour_key: Sequence[str], measures: Sequence[str], expected: int
) -> DataFrame:
    """Rows, distinct hours, missing hours, first and last date and null rate per measure.

    Two steps: rows collapse to one per (group, hour) with map-side combine, so the second
    aggregation sees at most one row per hour whatever share of the feed a group holds.
    """
    per_hour = df.groupBy(*by, *hour_key).agg(
        F.count("*").alias("n"),
        *[F.count(F.when(F.col(m).isNull(), 1)).alias(f"{m}_nulls") for m in measures],
    )
    return per_hour.groupBy(*by).agg(
        F.sum("n").alias("row_count"),
        F.count("*").alias("hours_present"),
        (F.lit(expected) - F.count("*")).alias("missing_hours"),
        F.min(hour_key[0]).alias("first_date"),
        F.max(hour_key[0]).alias("last_date"),
        *[
            (F.sum(f"{m}_nulls") / F.sum("n")).alias(f"{m}_null_rate")
            for m in measures
        ],
    )
