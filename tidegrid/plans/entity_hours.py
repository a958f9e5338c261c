"""Raw trips to the complete entity-hour table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.columns import masked, share, tally
from tidegrid.operators.aggregate import aggregate_by
from tidegrid.operators.grid import densify, hour_grid
from tidegrid.plans import study
from tidegrid.plans.declared import Declared

SUMS = ["n_events", "sum_value"]
EMPTY_HOUR = "no event in the hour"
DECLARED = [
    Declared("n_events", "target"),
    Declared("mean_value", "target", null=EMPTY_HOUR),
    Declared("sum_value", "leak_if_unlagged"),
]
LARGE = 100.0


def core_measures() -> dict[str, Column]:
    return {
        "n_events": F.count("*"),
        "sum_value": F.sum("fare"),
        "mean_value": F.avg("fare"),
    }


def full_measures() -> dict[str, Column]:
    """How many events and users, how their values spread, and the large and the coded ones apart."""
    large = F.col("fare") >= LARGE
    coded = F.col("rate_code").isNotNull()
    return {
        "n_events": F.count("*"),
        "sum_value": F.sum("fare"),
        "mean_value": F.avg("fare"),
        "median_value": F.percentile_approx("fare", 0.5),
        "top_value": F.max("fare"),
        "first_user": F.min("user_id"),
        "n_large": tally(large),
        "share_large": share(large),
        "mean_large": F.avg(masked(large, "fare")),
        "n_coded": tally(coded),
        "share_low_code": share(F.col("rate_code") < 5, known=coded),
        "mean_code": F.avg(masked(coded, "rate_code")),
    }


FULL_ZERO = ["n_events", "sum_value", "n_large", "n_coded"]


def entity_hours(
    spark: SparkSession, sf_dir: str, full: bool = False, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per ``(date, hour, entity)`` of the window, empty hours included.

    ``extra`` measures ride on the same aggregate; they stay null in an empty hour.
    """
    trips = study.trips(spark, sf_dir, coded=full or bool(extra))
    grid = hour_grid(spark, study.START, study.END, study.entities(spark))
    measures = {**(full_measures() if full else core_measures()), **(extra or {})}
    return densify(
        aggregate_by(trips, study.KEY, measures), grid, study.KEY, FULL_ZERO if full else SUMS
    )
