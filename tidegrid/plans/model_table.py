"""Entity hours, the arrival series, sites, calendar and history on one row per grid cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.functions.calendar import split_by_date, with_calendar, with_holidays
from tidegrid.operators.history import add_lags, add_trailing_means, history_flags, lag_outcomes
from tidegrid.operators.joins import checked_left_join
from tidegrid.plans import clocked, sites, study
from tidegrid.plans import entity_hours as entity_hours_plan
from tidegrid.plans.declared import Declared, feature_groups, null_reasons, roles
from tidegrid.plans.entity_hours import entity_hours

REALISED = [c.name for c in clocked.OUTCOMES]
CONTEXT_REALISED = [c.name for c in clocked.OUTCOMES_ELSEWHERE]
EARLY = "before the first lag"

CALENDAR = [
    Declared("hour", group="calendar"),
    Declared("day_of_week", group="calendar", kind="level"),
    *[Declared(c, group="calendar", kind="flag") for c in ("is_weekend", "is_holiday", "is_holiday_adjacent")],
    Declared("hour_sin", group="circle", kind="circle"),
    Declared("hour_cos", group="circle", kind="circle"),
    Declared("entity", group="kind", kind="level"),
    Declared("holiday_name", "descriptive", null="no holiday"),
    *[Declared(c, "descriptive") for c in ("day_name", "month", "year")],
    Declared("split", "flag", kind="level"),
]
HISTORY = [
    *[Declared(c, group="past_counts", null=EARLY) for c in ("n_lag_1h", "n_lag_24h", "n_lag_168h", "n_same_hour_7d")],
    *[Declared(c, group="past_values", null=EARLY, fill="median") for c in ("value_lag_168h", "value_same_hour_7d")],
    *[Declared(c, "flag", kind="flag") for c in ("has_count_history", "has_value_history")],
]
#: Every column of the model table, from what the plans that add them say.
DECLARED = [
    *[Declared(c, "key") for c in study.KEY],
    *entity_hours_plan.DECLARED,
    *clocked.PLANNED,
    *clocked.OUTCOMES,
    *clocked.OUTCOMES_ELSEWHERE,
    *[c.lagged(1, "past_arrivals") for c in clocked.OUTCOMES],
    *[c.lagged(1, "elsewhere") for c in clocked.OUTCOMES_ELSEWHERE],
    *sites.DECLARED,
    *CALENDAR,
    *HISTORY,
]
FEATURES = feature_groups(DECLARED)
ROLES = roles(DECLARED)
NULL_FAMILIES = null_reasons(DECLARED)


def with_history(df: DataFrame) -> DataFrame:
    """Lags of both targets, same-hour trailing means, and one flag per target."""
    lagged = add_lags(
        df,
        [
            ("n_events", 1, "n_lag_1h"),
            ("n_events", 24, "n_lag_24h"),
            ("n_events", 168, "n_lag_168h"),
            ("mean_value", 168, "value_lag_168h"),
        ],
        ["entity"],
    )
    trailing = add_trailing_means(
        lagged,
        {"n_events": "n_same_hour_7d", "mean_value": "value_same_hour_7d"},
        7,
        ["entity"],
    )
    return history_flags(
        trailing,
        {"has_count_history": ["n_lag_168h"], "has_value_history": ["value_lag_168h"]},
    )


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity hours with calendar, holidays, history and split: the forecasting table."""
    hours = with_calendar(entity_hours(spark, sf_dir))
    dated = with_holidays(hours, study.holidays(spark))
    return with_history(dated).select(
        "*", split_by_date("date", study.CUT).alias("split")
    )


def model_table(spark: SparkSession, sf_dir: str, checked: bool = False) -> DataFrame:
    """The full table. ``checked`` runs the uniqueness check before every join.

    Trips are read once for the targets and the site readings together, legs once for both
    arrival series; peers and context are windows over the sites of an hour.
    """

    def join(left, right, on, label):
        if checked:
            return checked_left_join(left, right, on, label)
        return left.join(right, on=on, how="left")

    hours = sites.resolve(sites.fill(entity_hours(spark, sf_dir, extra=sites.measures())))
    series = clocked.scheduled_realised(spark, sf_dir)
    table = clocked.with_context(join(hours, series, study.KEY, "arrivals"))
    table = with_holidays(with_calendar(table), study.holidays(spark))
    table = lag_outcomes(with_history(table), [*REALISED, *CONTEXT_REALISED], ["entity"])
    return table.select("*", split_by_date("date", study.CUT).alias("split"))
