"""Calendar, lags, trailing means, neighbours and lagged outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.functions.calendar import split_by_date, with_calendar, with_holidays
from tidegrid.operators.aggregate import count_by
from tidegrid.operators.evaluate import model_rows
from tidegrid.operators.history import add_lags, add_neighbours, add_trailing_means, lag_outcomes
from tidegrid.plans import study
from tidegrid.plans.entity_hours import entity_hours
from tidegrid.plans.model_table import history_table

W = "WINDOW w AS (PARTITION BY entity ORDER BY date, hour)"
HISTORY = (
    HOURS
    + """,
hist AS (
  SELECT *, lag(n_events, 1) OVER w AS n_lag_1h, lag(n_events, 24) OVER w AS n_lag_24h, lag(n_events, 168) OVER w AS n_lag_168h,
    lag(mean_value, 168) OVER w AS value_lag_168h,
    avg(n_events) OVER s AS n_same_hour_7d, avg(mean_value) OVER s AS value_same_hour_7d,
    CASE WHEN date < DATE '2024-01-22' THEN 'train' ELSE 'test' END AS split,
    CAST(isodow(date) AS INTEGER) AS day_of_week
  FROM hours WINDOW w AS (PARTITION BY entity ORDER BY date, hour),
    s AS (PARTITION BY entity, hour ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""
)


def _hours(spark, sf_dir):
    return entity_hours(spark, sf_dir)


@query(
    "lags",
    f"""WITH {HISTORY} SELECT date, hour, entity, n_events, n_lag_1h, n_lag_24h, n_lag_168h, round(value_lag_168h, 6) AS value_lag_168h FROM hist""",
)
def lags(spark, sf_dir):
    wanted = [
        ("n_events", 1, "n_lag_1h"),
        ("n_events", 24, "n_lag_24h"),
        ("n_events", 168, "n_lag_168h"),
        ("mean_value", 168, "value_lag_168h"),
    ]
    return rounded(add_lags(_hours(spark, sf_dir), wanted, ["entity"]).drop("sum_value", "mean_value"))


@query(
    "trailing_mean",
    f"""WITH {HISTORY} SELECT date, hour, entity, round(n_same_hour_7d, 6) AS n_same_hour_7d, round(value_same_hour_7d, 6) AS value_same_hour_7d FROM hist""",
)
def trailing(spark, sf_dir):
    means = {"n_events": "n_same_hour_7d", "mean_value": "value_same_hour_7d"}
    out = add_trailing_means(_hours(spark, sf_dir), means, 7, ["entity"])
    return rounded(out.select(*study.KEY, *means.values()))


@query(
    "neighbours",
    f"""WITH {HOURS} SELECT date, hour, entity, lag(n_events) OVER w AS n_events_prev_hr, lead(n_events) OVER w AS n_events_next_hr FROM hours {W}""",
)
def neighbours(spark, sf_dir):
    out = add_neighbours(_hours(spark, sf_dir), "n_events", ["entity"])
    return out.select(*study.KEY, "n_events_prev_hr", "n_events_next_hr")


@query(
    "lagged_outcomes",
    f"""WITH {HOURS} SELECT date, hour, entity, round(lag(sum_value) OVER w, 6) AS sum_value_lag_1h, round(lag(mean_value) OVER w, 6) AS mean_value_lag_1h FROM hours {W}""",
)
def lagged(spark, sf_dir):
    out = lag_outcomes(_hours(spark, sf_dir), ["sum_value", "mean_value"], ["entity"], drop=True)
    return rounded(out.drop("n_events"))


@query(
    "calendar",
    f"""WITH {HOURS} SELECT date, hour, entity, CAST(isodow(date) AS INTEGER) AS day_of_week, strftime(date, '%a') AS day_name,
      CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year, isodow(date) >= 6 AS is_weekend,
      round(sin(2 * pi() * hour / 24), 6) AS hour_sin, round(cos(2 * pi() * hour / 24), 6) AS hour_cos FROM hours""",
)
def calendar(spark, sf_dir):
    out = with_calendar(_hours(spark, sf_dir)).drop("n_events", "sum_value", "mean_value")
    return rounded(out).select(
        *[c for c in out.columns if c not in ("hour_sin", "hour_cos")],
        (F.round("hour_sin", 6) + 0.0).alias("hour_sin"),
        (F.round("hour_cos", 6) + 0.0).alias("hour_cos"),
    )


@query(
    "holidays",
    f"""WITH {HOURS}, h(date, name, kind) AS (VALUES (DATE '2024-01-01', 'New Year''s Day', 'federal'), (DATE '2024-01-02', 'Day after New Year', 'adjacent'),
      (DATE '2024-01-15', 'Martin Luther King Jr. Day', 'federal'))
    SELECT hours.date, hour, entity, n_events, name AS holiday_name, coalesce(kind = 'federal', false) AS is_holiday,
      coalesce(kind = 'adjacent', false) AS is_holiday_adjacent FROM hours LEFT JOIN h ON h.date = hours.date""",
)
def holidays(spark, sf_dir):
    hours = _hours(spark, sf_dir).drop("sum_value", "mean_value")
    return with_holidays(hours, study.holidays(spark))


@query(
    "split_sizes",
    f"""WITH {HISTORY} SELECT split, count(*) AS row_count FROM hist GROUP BY split""",
)
def split_sizes(spark, sf_dir):
    return count_by(
        _hours(spark, sf_dir).select(split_by_date("date", study.CUT).alias("split")), ["split"]
    )


@query(
    "model_rows",
    f"""WITH {HISTORY} SELECT split, count(*) AS usable_rows, count(mean_value) AS value_rows, count(value_lag_168h) AS with_value_history
    FROM hist WHERE n_lag_168h IS NOT NULL GROUP BY split""",
)
def usable(spark, sf_dir):
    rows = model_rows(history_table(spark, sf_dir), "has_count_history")
    return rows.groupBy("split").agg(
        F.count("*").alias("usable_rows"),
        F.count("mean_value").alias("value_rows"),
        F.count_if(F.col("has_value_history")).alias("with_value_history"),
    )
