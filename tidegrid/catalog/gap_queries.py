"""Bounded carry-forward, fallback with provenance, and cross-site checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import GRID, TRIPS, query, rounded
from tidegrid.operators.aggregate import count_by
from tidegrid.operators.gaps import fill_report, spread_check
from tidegrid.plans import sites

SITES = (
    TRIPS
    + ","
    + GRID
    + """,
obs AS (SELECT date, hour, entity, avg(CASE WHEN code < 20 THEN fare END) AS temp0,
          avg(CASE WHEN code >= 90 THEN greatest(fare - 50.0::DOUBLE, 0.0::DOUBLE) END) AS rain0 FROM trips GROUP BY 1, 2, 3),
raw AS (SELECT g.date, g.hour, g.entity, temp0, rain0 FROM grid g
        LEFT JOIN obs o ON o.date = g.date AND o.hour = g.hour AND o.entity = g.entity),
filled AS (
  SELECT date, hour, entity, temp0, rain0,
    coalesce(temp0, lag(temp0, 1) OVER w, lag(temp0, 2) OVER w, lag(temp0, 3) OVER w) AS temp,
    coalesce(rain0, lag(rain0, 1) OVER w) AS rain1
  FROM raw WINDOW w AS (PARTITION BY entity ORDER BY date, hour)),
peers AS (SELECT date, hour, avg(rain1) AS peer FROM filled WHERE entity IN ('click', 'signup', 'view') GROUP BY 1, 2),
sites AS (
  SELECT f.*, coalesce(rain1, peer, 0.0::DOUBLE) AS rain,
    CASE WHEN rain0 IS NOT NULL THEN 'observed' WHEN rain1 IS NOT NULL THEN 'carried' WHEN peer IS NOT NULL THEN 'peers' ELSE 'assumed' END AS rain_source,
    coalesce(rain1, peer, 0.0::DOUBLE) > 0 AS is_wet,
    (coalesce(rain1, peer, 0.0::DOUBLE) > 0) AND (temp <= 90) AS is_freezing
  FROM filled f LEFT JOIN peers p ON p.date = f.date AND p.hour = f.hour)"""
)


@query(
    "carried_forward",
    f"""WITH {SITES} SELECT date, hour, entity, round(temp, 6) AS temp, round(rain1, 6) AS rain,
      temp0 IS NULL AND temp IS NOT NULL AS temp_imputed, rain0 IS NULL AND rain1 IS NOT NULL AS rain_imputed,
      temp IS NULL AS temp_missing, rain1 IS NULL AS rain_missing FROM sites""",
)
def carried_forward(spark, sf_dir):
    return rounded(sites.filled(spark, sf_dir))


@query(
    "resolved_with_source",
    f"WITH {SITES} SELECT date, hour, entity, round(rain, 6) AS rain, rain_source, is_wet, is_freezing FROM sites",
)
def resolved(spark, sf_dir):
    return rounded(
        sites.resolved(spark, sf_dir).select(
            "date", "hour", "entity", "rain", "rain_source", "is_wet", "is_freezing"
        )
    )


@query(
    "source_counts",
    f"WITH {SITES} SELECT entity, rain_source, count(*) AS row_count FROM sites GROUP BY 1, 2",
)
def source_counts(spark, sf_dir):
    return count_by(sites.resolved(spark, sf_dir), ["entity", "rain_source"])


@query(
    "fill_report",
    f"""WITH {SITES} SELECT entity, count(*) FILTER (temp0 IS NULL AND temp IS NOT NULL) AS hours_filled, count(*) FILTER (temp IS NULL) AS hours_missing,
      count(*) FILTER (rain_source IN ('peers', 'assumed')) AS fallback_used, round(avg(CAST(is_wet AS DOUBLE)), 6) AS share_wet,
      round(avg(CAST(is_freezing AS DOUBLE)), 6) AS share_freezing, round(max(rain), 6) AS max_rain FROM sites GROUP BY entity""",
)
def fills(spark, sf_dir):
    return rounded(
        fill_report(
            sites.resolved(spark, sf_dir),
            ["entity"],
            {
                "hours_filled": F.col("temp_imputed"),
                "hours_missing": F.col("temp_missing"),
                "fallback_used": F.col("rain_source").isin("peers", "assumed"),
            },
            {"share_wet": F.col("is_wet"), "share_freezing": F.col("is_freezing")},
            ["rain"],
        )
    )


@query(
    "site_spread",
    f"""WITH {SITES}, s AS (SELECT date, hour, max(temp) - min(temp) AS spread FROM sites WHERE temp IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 5)
    SELECT count(*) AS hours_compared, round(avg(spread), 6) AS mean_spread, round(max(spread), 6) AS max_spread,
      round(quantile_disc(spread, 0.95), 6) AS high_spread FROM s""",
)
def site_spread(spark, sf_dir):
    return rounded(spread_check(sites.filled(spark, sf_dir), ["date", "hour"], "temp", 5))
