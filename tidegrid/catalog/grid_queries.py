"""Entity-hour grids and the aggregates on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import GRID, HOURS, LEGS, TRIPS, query, rounded
from tidegrid.functions.calendar import with_holidays
from tidegrid.functions.columns import in_wrapped_range
from tidegrid.operators.aggregate import count_by, regime_summary
from tidegrid.operators.grid import zero_report
from tidegrid.operators.reshape import top_k, top_per_group
from tidegrid.plans import clocked, study
from tidegrid.plans.entity_hours import entity_hours


@query(
    "entity_hour_grid",
    f"WITH {HOURS} SELECT date, hour, entity, n_events, round(sum_value, 8) AS sum_value, "
    "round(mean_value, 8) AS mean_value FROM hours",
)
def entity_hour_grid(spark, sf_dir):
    return rounded(entity_hours(spark, sf_dir), 8)


@query(
    "entity_hour_measures",
    f"""WITH {TRIPS}, {GRID},
    agg AS (
      SELECT date, hour, entity, count(*) AS n_events, sum(fare) AS sum_value, avg(fare) AS mean_value,
        quantile_disc(fare, 0.5) AS median_value, max(fare) AS top_value, min(user_id) AS first_user,
        count(*) FILTER (fare >= 100) AS n_large, avg(CASE WHEN fare >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share_large,
        avg(CASE WHEN fare >= 100 THEN fare END) AS mean_large, count(rate_code) AS n_coded,
        avg(CASE WHEN rate_code IS NULL THEN NULL WHEN rate_code < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share_low_code,
        avg(rate_code) AS mean_code
      FROM trips GROUP BY date, hour, entity)
    SELECT g.date, g.hour, g.entity, coalesce(n_events, 0) AS n_events, round(coalesce(sum_value, 0), 8) AS sum_value,
      round(mean_value, 8) AS mean_value, round(median_value, 8) AS median_value, round(top_value, 8) AS top_value, first_user,
      coalesce(n_large, 0) AS n_large, round(share_large, 8) AS share_large, round(mean_large, 8) AS mean_large,
      coalesce(n_coded, 0) AS n_coded, round(share_low_code, 8) AS share_low_code, round(mean_code, 8) AS mean_code
    FROM grid g LEFT JOIN agg a ON a.date = g.date AND a.hour = g.hour AND a.entity = g.entity""",
)
def entity_hour_measures(spark, sf_dir):
    return rounded(entity_hours(spark, sf_dir, full=True), 8)


@query(
    "empty_cells",
    f"""WITH {HOURS} SELECT entity, count(*) AS cells, count(*) FILTER (n_events = 0) AS empty_cells,
      round(avg(CASE WHEN n_events = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_empty,
      count(*) FILTER (n_events = 0 AND (hour >= 22 OR hour < 6)) AS empty_in_band,
      count(*) FILTER (n_events = 0 AND NOT (date = DATE '2024-01-01' AND hour = 0)) AS genuine_empty
    FROM hours GROUP BY entity""",
)
def empty_cells(spark, sf_dir):
    edge = (F.col("date") == F.lit(study.START).cast("date")) & (F.col("hour") == 0)
    hours = entity_hours(spark, sf_dir)
    return rounded(
        zero_report(hours, "n_events", ["entity"], in_wrapped_range("hour", 22, 6), edge)
    )


@query(
    "count_by",
    f"WITH {TRIPS} SELECT entity, rate_code, count(*) AS row_count FROM trips GROUP BY entity, rate_code",
)
def counted_by(spark, sf_dir):
    return count_by(study.trips(spark, sf_dir), ["entity", "rate_code"])


@query(
    "context_hours",
    f"""WITH {GRID}, {LEGS},
    agg AS (SELECT sched_date AS date, sched_hour AS hour, count(*) AS a, sum(distance) AS d, count(delay) AS n,
              avg(delay) AS m, avg(CASE WHEN cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS c
            FROM kept WHERE entity = 'error' GROUP BY 1, 2)
    SELECT g.date, g.hour, coalesce(a, 0) AS ctx_sched_arrivals, round(coalesce(d, 0), 4) AS ctx_sched_distance,
      coalesce(n, 0) AS ctx_n_delay_observed, round(m, 4) AS ctx_mean_delay, round(c, 4) AS ctx_share_cancelled
    FROM (SELECT DISTINCT date, hour FROM grid) g LEFT JOIN agg ON agg.date = g.date AND agg.hour = g.hour""",
)
def context(spark, sf_dir):
    return rounded(clocked.context_hours(spark, sf_dir), 4)


@query(
    "busiest_hours",
    f"""WITH {HOURS}, m AS (SELECT entity, hour, avg(n_events) AS mean_events FROM hours GROUP BY entity, hour),
    r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY round(mean_events, 6) DESC, hour) AS rank FROM m)
    SELECT entity, hour, round(mean_events, 6) AS mean_events, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def busiest_hours(spark, sf_dir):
    means = entity_hours(spark, sf_dir).groupBy("entity", "hour").agg(
        F.round(F.avg("n_events"), 6).alias("mean_events")
    )
    return top_per_group(means, ["entity"], [F.desc("mean_events"), F.col("hour")], 3)


@query(
    "entity_summary",
    f"""WITH {HOURS} SELECT entity, CAST(sum(n_events) AS BIGINT) AS events, round(avg(n_events), 6) AS mean_per_hour,
      max(n_events) AS max_in_one_hour, round(avg(mean_value), 6) AS mean_of_means,
      count(*) FILTER (n_events = 0) AS hours_with_nothing
    FROM hours GROUP BY entity""",
)
def entity_summary(spark, sf_dir):
    return rounded(
        entity_hours(spark, sf_dir)
        .groupBy("entity")
        .agg(
            F.sum("n_events").alias("events"),
            F.avg("n_events").alias("mean_per_hour"),
            F.max("n_events").alias("max_in_one_hour"),
            F.avg("mean_value").alias("mean_of_means"),
            F.count(F.when(F.col("n_events") == 0, 1)).alias("hours_with_nothing"),
        )
    )


@query(
    "fullest_cells",
    f"""WITH {HOURS} SELECT date, hour, entity, n_events FROM hours
    ORDER BY n_events DESC, date, hour, entity LIMIT 20""",
)
def fullest_cells(spark, sf_dir):
    hours = entity_hours(spark, sf_dir).select(*study.KEY, "n_events")
    return top_k(hours, [F.desc("n_events"), *[F.col(k) for k in study.KEY]], 20)


@query(
    "regime_summary",
    f"""WITH {HOURS}, h(date, kind) AS (VALUES (DATE '2024-01-01', 'federal'), (DATE '2024-01-02', 'adjacent'), (DATE '2024-01-15', 'federal')),
    j AS (SELECT hours.*, coalesce(h.kind = 'federal', false) AS is_holiday, coalesce(h.kind = 'adjacent', false) AS is_holiday_adjacent
          FROM hours LEFT JOIN h ON h.date = hours.date)
    SELECT is_holiday, is_holiday_adjacent, count(DISTINCT date) AS days, round(avg(n_events), 6) AS mean_events,
      round(avg(mean_value), 6) AS mean_of_means FROM j GROUP BY 1, 2""",
)
def regimes(spark, sf_dir):

    hours = with_holidays(entity_hours(spark, sf_dir), study.holidays(spark))
    return rounded(
        regime_summary(
            hours,
            ["is_holiday", "is_holiday_adjacent"],
            "date",
            {"mean_events": F.avg("n_events"), "mean_of_means": F.avg("mean_value")},
        )
    )
