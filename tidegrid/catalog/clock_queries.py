"""Clock corrections, edges of the window, realised against scheduled, and DST."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import GRID, LEGS, query, rounded
from tidegrid.functions.clock import dst_kind, hhmm_hour, hhmm_minutes, utc_to_local, valid_hhmm
from tidegrid.functions.columns import share, tally
from tidegrid.operators.gaps import collapse_duplicates
from tidegrid.operators.order_stats import bracketed_counts, exact_quantiles, quantile_columns
from tidegrid.operators.rules import apply_rules, edge_report, rule_waterfall, status_counts
from tidegrid.plans import clocked, study

ZONE = "America/New_York"


@query(
    "clock_keys",
    f"""WITH {LEGS} SELECT event_id, sched_date, sched_hour, actual_date, actual_hour,
      CAST(block AS BIGINT) AS block_minutes FROM keyed WHERE code <> 50 AND cancelled = 0""",
)
def clock_keys(spark, sf_dir):
    """Keys rebuilt from the clocks alone must equal date arithmetic on the stamps."""
    legs = clocked.keyed_legs(spark, sf_dir).where(
        valid_hhmm("arr_hhmm") & valid_hhmm("dep_hhmm") & valid_hhmm("act_hhmm")
    )
    return legs.select(
        "event_id",
        "sched_date",
        "sched_hour",
        "actual_date",
        "actual_hour",
        clocked.block_minutes().cast("long").alias("block_minutes"),
    )


@query(
    "hhmm_validity",
    """WITH o AS (SELECT CAST(o_orderkey % 2600 - 100 AS INTEGER) AS hhmm, count(*) AS n FROM orders GROUP BY 1)
    SELECT hhmm, hhmm >= 0 AND hhmm <= 2400 AND hhmm % 100 < 60 AS is_valid, CAST(floor(hhmm / 100.0) AS INTEGER) AS hour_part,
      CAST(CASE WHEN hhmm >= 0 THEN hhmm // 100 * 60 + hhmm % 100 END AS INTEGER) AS minute_of_day, n AS row_count FROM o""",
)
def hhmm_validity(spark, sf_dir):
    codes = study.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 2600 - 100).cast("int").alias("hhmm")
    )
    counted = codes.groupBy("hhmm").agg(F.count("*").alias("row_count"))
    return counted.select(
        "hhmm",
        valid_hhmm("hhmm").alias("is_valid"),
        hhmm_hour("hhmm").alias("hour_part"),
        F.when(F.col("hhmm") >= 0, hhmm_minutes("hhmm")).alias("minute_of_day"),
        "row_count",
    )


@query(
    "clock_diagnostics",
    f"""WITH {LEGS}, w AS (SELECT * FROM keyed WHERE code <> 50)
    SELECT count(*) AS rows_examined, round(avg(CASE WHEN sched_date <> leg_date THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_overnight,
      min(block) AS min_block, CAST(quantile_disc(block, 0.5) AS DOUBLE) AS median_block, max(block) AS max_block,
      count(*) FILTER (block > 1080) AS implausible_rows, count(*) FILTER ((dep_minute + block) % 1440 = 0) AS midnight_rows FROM w""",
)
def clock_diagnostics(spark, sf_dir):
    legs = clocked.keyed_legs(spark, sf_dir).where(valid_hhmm("arr_hhmm") & valid_hhmm("dep_hhmm"))
    block = clocked.block_minutes()
    counts = bracketed_counts(legs, {"block": block}, [0.5])
    median = quantile_columns(
        exact_quantiles(counts, ["metric"], [0.5], fixed_groups=True), ["metric"], {"median_block": 0.5}
    ).select("median_block")
    return rounded(
        legs.agg(
            F.count("*").alias("rows_examined"),
            share(F.col("sched_date") != F.col("leg_date")).alias("share_overnight"),
            F.min(block).alias("min_block"),
            F.max(block).alias("max_block"),
            tally(block > clocked.MAX_BLOCK).alias("implausible_rows"),
            tally(F.col("arr_hhmm") == 2400).alias("midnight_rows"),
        ).select("*", median.scalar().alias("median_block"))
    )


@query(
    "leg_waterfall",
    f"""WITH {LEGS}, s AS (
      SELECT 0 AS step_no, 'raw' AS step, count(*) AS row_count FROM keyed
      UNION ALL SELECT 1, 'well-formed scheduled clocks', count(*) FROM keyed WHERE code <> 50
      UNION ALL SELECT 2, 'plausible implied block', count(*) FROM keyed WHERE code <> 50 AND block <= 1080
      UNION ALL SELECT 3, 'scheduled arrival in window', count(*) FROM kept)
    SELECT step_no, step, row_count, lag(row_count) OVER (ORDER BY step_no) - row_count AS removed,
      round(100.0::DOUBLE * row_count / first_value(row_count) OVER (ORDER BY step_no), 3) AS pct_of_raw FROM s""",
)
def leg_waterfall(spark, sf_dir):
    return rule_waterfall(clocked.keyed_legs(spark, sf_dir), clocked.rules())


@query(
    "edge_report",
    f"""WITH {LEGS}, e AS (SELECT
      count(*) FILTER (leg_date < DATE '2024-01-08' AND sched_date >= DATE '2024-01-08') AS recovered_at_start,
      count(*) FILTER (code <> 50 AND sched_date >= DATE '2024-01-22') AS rolled_past_end,
      count(*) FILTER (sched_date = DATE '2024-01-08') AS first_day_rows,
      count(*) FILTER (leg_date < DATE '2024-01-08' AND sched_date = DATE '2024-01-08') AS first_day_recovered FROM keyed)
    SELECT *, round(CASE WHEN first_day_rows > 0 THEN 100.0::DOUBLE * first_day_recovered / first_day_rows END, 6) AS first_day_recovered_pct FROM e""",
)
def edges(spark, sf_dir):
    legs = clocked.keyed_legs(spark, sf_dir)
    formed = valid_hhmm("arr_hhmm") & valid_hhmm("dep_hhmm")
    return rounded(edge_report(legs, "sched_date", "leg_date", "2024-01-08", "2024-01-22", formed))


@query(
    "status_counts",
    f"""WITH {LEGS} SELECT entity, count(*) FILTER (cancelled = 1) AS cancelled, count(*) FILTER (diverted = 1) AS diverted,
      count(*) FILTER (actual_hour IS NULL) AS null_actual, count(*) FILTER (delay IS NULL) AS null_delay FROM kept GROUP BY entity""",
)
def statuses(spark, sf_dir):
    legs = apply_rules(clocked.keyed_legs(spark, sf_dir), clocked.rules())
    conditions = {
        "cancelled": F.col("cancelled") == 1,
        "diverted": F.col("diverted") == 1,
        "null_actual": F.col("act_hhmm").isNull(),
        "null_delay": F.col("delay").isNull(),
    }
    return status_counts(legs, conditions, ["entity"])


@query(
    "scheduled_realised",
    f"""WITH {GRID}, {LEGS},
    s AS (SELECT sched_date AS date, sched_hour AS hour, entity, count(*) AS n, sum(distance) AS d,
            avg(CASE WHEN distance >= 400 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS lh, avg(CASE WHEN cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS ca,
            count(delay) AS nd, avg(delay) AS md, avg(CASE WHEN delay IS NOT NULL THEN CASE WHEN delay >= 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END) AS la
          FROM kept GROUP BY 1, 2, 3),
    a AS (SELECT actual_date AS date, actual_hour AS hour, entity, count(*) AS n FROM kept
          WHERE cancelled = 0 AND coalesce(diverted, 0) = 0 AND actual_date >= DATE '2024-01-01' AND actual_date < DATE '2024-01-31' GROUP BY 1, 2, 3),
    t AS (SELECT g.date, g.hour, g.entity, coalesce(s.n, 0) AS sched_arrivals, coalesce(d, 0) AS sched_distance, lh, ca,
            coalesce(nd, 0) AS n_delay_observed, md, la, coalesce(a.n, 0) AS actual_arrivals
          FROM grid g LEFT JOIN s ON s.date = g.date AND s.hour = g.hour AND s.entity = g.entity
          LEFT JOIN a ON a.date = g.date AND a.hour = g.hour AND a.entity = g.entity)
    SELECT date, hour, entity, sched_arrivals, round(sched_distance, 4) AS sched_distance, round(lh, 4) AS share_longhaul, round(ca, 4) AS share_cancelled,
      n_delay_observed, round(md, 4) AS mean_delay, round(la, 4) AS share_late, actual_arrivals,
      actual_arrivals - sched_arrivals AS arrival_slippage,
      lag(sched_arrivals) OVER w AS sched_arrivals_prev_hr, lead(sched_arrivals) OVER w AS sched_arrivals_next_hr
    FROM t WINDOW w AS (PARTITION BY entity ORDER BY date, hour)""",
)
def scheduled_realised(spark, sf_dir):
    return rounded(clocked.scheduled_realised(spark, sf_dir), 4)


@query(
    "dst_collapse",
    """WITH e AS (SELECT event_type AS entity, ts - INTERVAL 70 DAY AS utc, value FROM events),
    l AS (SELECT entity, CAST(date_trunc('hour', utc) AS TIMESTAMP) AS utc_hour, avg(value) AS value FROM e GROUP BY 1, 2),
    z AS (SELECT entity, utc_hour, value, (utc_hour AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local FROM l),
    c AS (SELECT * FROM z WHERE local >= TIMESTAMP '2023-10-24' AND local < TIMESTAMP '2023-11-21')
    SELECT entity, CAST(local AS DATE) AS date, CAST(hour(local) AS INTEGER) AS hour, round(avg(value), 6) AS value, count(*) AS merged_rows
    FROM c GROUP BY 1, 2, 3""",
)
def dst_collapse(spark, sf_dir):
    """Zoned hourly readings on the local grid; the hour that runs twice is averaged once."""
    shifted = study.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity"),
        F.timestamp_add("DAY", F.lit(-70), F.col("ts")).alias("utc"),
        "value",
    )
    hourly = shifted.groupBy(
        "entity", F.to_date("utc").alias("utc_date"), F.hour("utc").alias("utc_hour")
    ).agg(F.avg("value").alias("value"))
    utc = F.timestamp_add("HOUR", F.col("utc_hour"), F.col("utc_date").cast("timestamp_ntz"))
    local = hourly.select("entity", "value", utc_to_local(utc, ZONE).alias("local"))
    clipped = local.where(
        (F.col("local") >= F.lit("2023-10-24").cast("timestamp_ntz"))
        & (F.col("local") < F.lit("2023-11-21").cast("timestamp_ntz"))
    ).select("entity", F.to_date("local").alias("date"), F.hour("local").alias("hour"), "value")
    return rounded(collapse_duplicates(clipped, ["entity", "date", "hour"], ["value"]))


@query(
    "dst_hours",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1),
    h AS (SELECT date, CAST(h AS INTEGER) AS hour, orders, CAST(date AS TIMESTAMP) + h * INTERVAL 1 HOUR AS local FROM d, range(24) t(h)),
    u AS (SELECT *, (local AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc FROM h),
    k AS (SELECT *, (utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS back,
      ((utc + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS after,
      ((utc - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS before FROM u)
    SELECT date, hour, CASE WHEN back <> local THEN 'skipped' ELSE 'repeated' END AS kind, orders FROM k
    WHERE back <> local OR after = local OR before = local""",
)
def dst_hours(spark, sf_dir):
    """Skipped and repeated clock hours on the days that have orders."""
    days = study.table(spark, sf_dir, "orders").groupBy(
        F.to_date("o_orderdate").alias("date")
    ).agg(F.count("*").alias("orders"))
    hours = days.select("date", "orders", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return hours.select("date", "hour", dst_kind("date", "hour", ZONE).alias("kind"), "orders").where(
        F.col("kind").isNotNull()
    )
