"""Registration of queries and oracles, and the SQL fragments the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its oracle where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, because the order of addition differs between engines."""
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), digits).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


GRID = """
grid AS (
  SELECT CAST(d AS DATE) AS date, CAST(h AS INTEGER) AS hour, entity
  FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) a(d),
       range(24) b(h),
       (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) c(entity))"""

TRIPS = """
base AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
         event_type AS entity, value AS fare, CAST(json_extract_string(props, '$.k') AS INTEGER) AS code
  FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'),
trips AS (
  SELECT *, NULLIF(code % 7, 0) AS passengers, NULLIF(code % 10, 9) AS rate_code,
         fare + code / 4.0::DOUBLE AS total, fare * 0.15::DOUBLE + code / 100.0::DOUBLE AS tip
  FROM base)"""

HOURS = (
    TRIPS
    + ","
    + GRID
    + """,
agg AS (
  SELECT date, hour, entity, count(*) AS n_events, sum(fare) AS sum_value, avg(fare) AS mean_value
  FROM trips GROUP BY date, hour, entity),
hours AS (
  SELECT g.date, g.hour, g.entity, coalesce(a.n_events, 0) AS n_events,
         coalesce(a.sum_value, 0) AS sum_value, a.mean_value
  FROM grid g LEFT JOIN agg a ON a.date = g.date AND a.hour = g.hour AND a.entity = g.entity)"""
)

LEGS = """
leg0 AS (
  SELECT event_id, event_type AS entity, ts, CAST(ts AS DATE) AS leg_date,
         CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS dep_minute,
         CAST(floor(value) AS INTEGER) AS block, value * 2.0::DOUBLE AS distance,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS code
  FROM events),
legs AS (
  SELECT *, code < 3 AS is_cancelled, code = 99 AS is_diverted, greatest(code - 80, 0) AS late,
         date_trunc('minute', ts) + block * INTERVAL 1 MINUTE AS sched_at,
         date_trunc('minute', ts) + (block + greatest(code - 80, 0)) * INTERVAL 1 MINUTE AS actual_at
  FROM leg0),
keyed AS (
  SELECT event_id, entity, leg_date, dep_minute, block, distance, code,
         CASE WHEN code <> 50 THEN CAST(sched_at AS DATE) ELSE leg_date END AS sched_date,
         CASE WHEN code <> 50 THEN CAST(hour(sched_at) AS INTEGER) END AS sched_hour,
         CASE WHEN NOT is_cancelled THEN CAST(actual_at AS DATE) ELSE leg_date END AS actual_date,
         CASE WHEN NOT is_cancelled THEN CAST(hour(actual_at) AS INTEGER) END AS actual_hour,
         CASE WHEN NOT is_cancelled AND NOT is_diverted THEN CAST(late AS DOUBLE) END AS delay,
         CAST(is_cancelled AS DOUBLE) AS cancelled,
         CASE WHEN code <> 98 THEN CAST(is_diverted AS DOUBLE) END AS diverted
  FROM legs),
kept AS (
  SELECT * FROM keyed
  WHERE code <> 50 AND block <= 1080 AND sched_date >= DATE '2024-01-01' AND sched_date < DATE '2024-01-31')"""
