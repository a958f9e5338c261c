"""Hourly readings per site with real gaps, filled and resolved like a weather feed.

A reading is the mean value of the events with a low code, so many hours have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.gaps import carry_forward, resolve_with_source, with_conditions
from tidegrid.operators.joins import peer_mean
from tidegrid.plans.declared import Declared
from tidegrid.plans.entity_hours import entity_hours

SMOOTH_HOURS, EVENT_HOURS = 3, 1
FALLBACK_SITES = ("click", "signup", "view")
COLD_BELOW = 90.0
GAP = "no reading within the fill limit"
DECLARED = [
    Declared("temp", group="weather", null=GAP, fill="median"),
    Declared("rain", group="weather"),
    Declared("is_wet", group="weather", kind="flag"),
    Declared("is_freezing", group="weather", null=GAP, kind="flag"),
    *[Declared(f"{c}_{what}", "flag", kind="flag") for c in ("temp", "rain") for what in ("imputed", "missing")],
    Declared("rain_source", "flag", kind="level"),
]


def measures() -> dict[str, Column]:
    """Hourly readings as aggregates of the trips; null where nothing was observed."""
    return {
        "temp": F.avg(F.when(F.col("code") < 20, F.col("fare"))),
        "rain": F.avg(F.when(F.col("code") >= 90, F.greatest(F.col("fare") - 50.0, F.lit(0.0)))),
    }


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete grid with readings carried forward within their limits."""
    return fill(entity_hours(spark, sf_dir, extra=measures()).drop("n_events", "sum_value", "mean_value"))


def fill(grid: DataFrame) -> DataFrame:
    return carry_forward(
        grid, {"temp": SMOOTH_HOURS, "rain": EVENT_HOURS}, ["entity"], ["date", "hour"]
    )


def resolve(filled_grid: DataFrame) -> DataFrame:
    """Rain from the site, its peers or an assumed zero, with conditions derived from it."""
    peers = peer_mean(
        filled_grid, ["date", "hour"], "rain", F.col("entity").isin(*FALLBACK_SITES), "rain_peers"
    )
    known = resolve_with_source(peers, "rain", "rain_peers", 0.0, carried="rain_imputed")
    wet = F.col("rain") > 0
    return with_conditions(
        known.drop("rain_peers", "rain_peers_reporting"),
        {"is_wet": wet, "is_freezing": wet & (F.col("temp") <= COLD_BELOW)},
    )


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(filled(spark, sf_dir))
