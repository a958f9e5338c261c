"""Complete hour grids and the left join that turns absence into an explicit zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.columns import tally


def hour_grid(
    spark: SparkSession,
    start: str,
    end: str,
    entities: DataFrame | None = None,
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Every ``(date, hour)`` of ``[start, end)``, for every row of ``entities`` if given.

    Dates and hours are generated from each entity row, so the product needs no cross join and
    streams at any number of entities.
    """
    base = spark.range(1).select() if entities is None else entities
    keys = base.columns
    days = F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    return (
        base.select(*keys, F.explode(days).alias(date))
        .select(*keys, date, F.explode(F.sequence(F.lit(0), F.lit(23))).alias(hour))
        .select(date, hour, *keys)
    )


def densify(
    aggregate: DataFrame, grid: DataFrame, on: Sequence[str], zero: Sequence[str]
) -> DataFrame:
    """Left-join an aggregate on the grid; zero-fill counts and sums, leave means null."""
    joined = grid.join(aggregate, on=list(on), how="left")
    return joined.fillna(0, subset=list(zero)) if zero else joined


def zero_report(
    df: DataFrame,
    count: str,
    by: Sequence[str],
    band: Column,
    artefact: Column | None = None,
) -> DataFrame:
    """Empty cells per group: how many, what share, how many in a clock band, how many real."""
    empty = F.col(count) == 0
    fake = artefact if artefact is not None else F.lit(False)
    return df.groupBy(*by).agg(
        F.count("*").alias("cells"),
        tally(empty).alias("empty_cells"),
        F.avg(F.when(empty, 1.0).otherwise(0.0)).alias("share_empty"),
        tally(empty & band).alias("empty_in_band"),
        tally(empty & ~fake).alias("genuine_empty"),
    )


def check_grid(
    df: DataFrame,
    keys: Sequence[str],
    expected_rows: int,
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(check_name, violations)``: completeness, key uniqueness and row-level invariants.

    Rows first collapse to one per key with their violations counted, so all checks come from
    one shuffle.
    """
    checks = dict(checks or {})
    names = list(checks)
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("copies"),
        *[tally(checks[name]).alias(f"bad_{i}") for i, name in enumerate(names)],
    )
    totals = per_key.agg(
        F.abs(F.coalesce(F.sum("copies"), F.lit(0)) - F.lit(expected_rows)).alias("grid_rows"),
        tally(F.col("copies") > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(f"bad_{i}"), F.lit(0)).alias(name) for i, name in enumerate(names)],
    )
    return totals.unpivot([], ["grid_rows", "duplicate_keys", *names], "check_name", "violations")
