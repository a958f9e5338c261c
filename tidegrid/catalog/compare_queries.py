"""Ratios, lagged correlation, matched comparison, event days and destination mixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.gap_queries import SITES
from tidegrid.catalog.history_queries import HISTORY
from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.operators.aggregate import (
    group_share,
    mix_shift,
    ratio_of_sums,
    regroup_means,
    zone_flows,
    zone_table,
)
from tidegrid.operators.compare import (
    baseline_ratio,
    event_day_compare,
    event_day_profile,
    lag_correlation,
    matched_cells,
    matched_compare,
    peak_lag,
    t_statistic,
)
from tidegrid.operators.reshape import arg_extreme, entity_columns
from tidegrid.plans import sites, study
from tidegrid.plans.entity_hours import entity_hours
from tidegrid.plans.model_table import history_table
from tidegrid.sources.staging import stage

# Purchases as the outcome, sign-ups as its driver, side by side on the hour grid.
PAIRS = (
    HOURS
    + """,
pairs AS (SELECT date, hour, max(n_events) FILTER (entity = 'purchase') AS outcome, max(n_events) FILTER (entity = 'signup') AS driver FROM hours GROUP BY 1, 2)"""
)


def _pairs(spark, sf_dir):
    hours = entity_hours(spark, sf_dir)
    return hours.groupBy("date", "hour").agg(
        F.max(F.when(F.col("entity") == "purchase", F.col("n_events"))).alias("outcome"),
        F.max(F.when(F.col("entity") == "signup", F.col("n_events"))).alias("driver"),
    )


@query(
    "ratio_of_sums",
    f"""WITH {PAIRS}, a AS (SELECT hour, sum(outcome) AS n, sum(driver) AS d, count(DISTINCT date) AS days FROM pairs GROUP BY hour)
    SELECT hour, CAST(n AS BIGINT) AS numerator, CAST(d AS BIGINT) AS denominator, days, round(d::DOUBLE / days, 6) AS per_day,
      round(CASE WHEN d::DOUBLE / days >= 2.5 THEN n::DOUBLE / d END, 6) AS ratio FROM a""",
)
def ratios(spark, sf_dir):
    return rounded(ratio_of_sums(_pairs(spark, sf_dir), "outcome", "driver", ["hour"], "date", 2.5))


@query(
    "conversion_by_entity",
    f"""WITH {HOURS} SELECT entity, CAST(sum(sum_value) AS DOUBLE) IS NOT NULL AS defined, round(sum(sum_value) / sum(n_events), 6) AS ratio FROM hours GROUP BY entity""",
)
def conversion(spark, sf_dir):
    out = ratio_of_sums(entity_hours(spark, sf_dir), "sum_value", "n_events", ["entity"])
    return rounded(out.select("entity", F.col("numerator").isNotNull().alias("defined"), "ratio"))


@query(
    "lag_correlation",
    f"""WITH {HOURS}, o AS (SELECT *, lag(mean_value, 0) OVER w AS unused FROM hours WINDOW w AS (PARTITION BY entity ORDER BY date, hour)),
    s AS (SELECT entity, n_events AS x, lag(sum_value, -2) OVER w AS a, lag(sum_value, -1) OVER w AS b, sum_value AS c, lag(sum_value, 1) OVER w AS d, lag(sum_value, 2) OVER w AS e
          FROM hours WINDOW w AS (PARTITION BY entity ORDER BY date, hour))
    SELECT entity, -2 AS lag_hours, round(corr(x, a), 6) AS correlation FROM s GROUP BY entity UNION ALL
    SELECT entity, -1, round(corr(x, b), 6) FROM s GROUP BY entity UNION ALL SELECT entity, 0, round(corr(x, c), 6) FROM s GROUP BY entity UNION ALL
    SELECT entity, 1, round(corr(x, d), 6) FROM s GROUP BY entity UNION ALL SELECT entity, 2, round(corr(x, e), 6) FROM s GROUP BY entity""".replace(
        "o AS (SELECT *, lag(mean_value, 0) OVER w AS unused FROM hours WINDOW w AS (PARTITION BY entity ORDER BY date, hour)),\n    ", ""
    ),
)
def lagged(spark, sf_dir):
    table = lag_correlation(
        entity_hours(spark, sf_dir), "n_events", "sum_value", [-2, -1, 0, 1, 2], ["entity"]
    )
    return rounded(table)


@query(
    "peak_lag",
    f"""WITH {HOURS}, s AS (SELECT entity, n_events AS x, lag(sum_value, -1) OVER w AS b, sum_value AS c, lag(sum_value, 1) OVER w AS d
          FROM hours WINDOW w AS (PARTITION BY entity ORDER BY date, hour)),
    r AS (SELECT entity, -1 AS k, corr(x, b) AS v FROM s GROUP BY entity UNION ALL SELECT entity, 0, corr(x, c) FROM s GROUP BY entity
      UNION ALL SELECT entity, 1, corr(x, d) FROM s GROUP BY entity)
    SELECT entity, k AS peak_lag, round(v, 6) AS peak_correlation FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY v DESC, k) AS i FROM r) WHERE i = 1""",
)
def peak(spark, sf_dir):
    table = lag_correlation(entity_hours(spark, sf_dir), "n_events", "sum_value", [-1, 0, 1], ["entity"])
    return rounded(peak_lag(table, ["entity"]))


# Wet hours by the resolved gauge, matched within (entity, hour of day).
MATCHED = (
    SITES
    + """,
events_by_cell AS (SELECT date, hour, entity, count(*) AS n, avg(fare) AS m FROM trips GROUP BY 1, 2, 3),
joined AS (SELECT s.date, s.hour, s.entity, s.is_wet, coalesce(e.n, 0) AS n_events, e.m AS mean_value FROM sites s
           LEFT JOIN events_by_cell e ON e.date = s.date AND e.hour = s.hour AND e.entity = s.entity),
wet AS (SELECT entity, hour, count(*) AS rows_on, avg(n_events) AS n_on, avg(mean_value) AS v_on FROM joined WHERE is_wet GROUP BY 1, 2),
dry AS (SELECT entity, hour, count(*) AS rows_off, avg(n_events) AS n_off, avg(mean_value) AS v_off FROM joined WHERE NOT is_wet GROUP BY 1, 2),
matched AS (SELECT wet.*, rows_off, n_off, v_off, n_on - n_off AS n_delta, v_on - v_off AS v_delta FROM wet JOIN dry ON dry.entity = wet.entity AND dry.hour = wet.hour)"""
)


def _matched(spark, sf_dir):
    hours = sites.resolve(sites.fill(entity_hours(spark, sf_dir, extra=sites.measures())))
    return matched_cells(
        hours, F.col("is_wet"), ["entity", "hour"], {"n": "n_events", "v": "mean_value"}
    )


@query(
    "matched_cells",
    f"""WITH {MATCHED} SELECT entity, hour, rows_on, rows_off, round(n_on, 6) AS n_on, round(n_off, 6) AS n_off, round(v_on, 6) AS v_on, round(v_off, 6) AS v_off,
      round(n_delta, 6) AS n_delta, round(v_delta, 6) AS v_delta FROM matched""",
)
def cells(spark, sf_dir):
    return rounded(_matched(spark, sf_dir))


@query(
    "matched_compare",
    f"""WITH {MATCHED} SELECT entity, CAST(sum(rows_on) AS BIGINT) AS exposure, count(*) AS cells,
      round(sum(n_delta * rows_on) / sum(rows_on), 6) AS n_delta, round(100.0::DOUBLE * sum(n_delta * rows_on) / sum(n_off * rows_on), 6) AS n_pct,
      round(sum(v_delta * rows_on) / sum(rows_on) FILTER (v_delta IS NOT NULL), 6) AS v_delta,
      round(100.0::DOUBLE * (sum(v_delta * rows_on) / sum(rows_on) FILTER (v_delta IS NOT NULL)) / (sum(v_off * rows_on) / sum(rows_on) FILTER (v_off IS NOT NULL)), 6) AS v_pct
    FROM matched GROUP BY entity""",
)
def compared(spark, sf_dir):
    return rounded(matched_compare(_matched(spark, sf_dir), ["entity"], ["n", "v"]))


@query(
    "t_statistic",
    f"""WITH {MATCHED} SELECT entity, count(n_delta) AS n, round(avg(n_delta), 6) AS mean_delta, round(stddev_samp(n_delta), 6) AS sd,
      round(avg(n_delta) / (stddev_samp(n_delta) / sqrt(count(n_delta))), 6) AS t FROM matched GROUP BY entity""",
)
def t_test(spark, sf_dir):
    """The statistic has an oracle; its probability is checked against known quantiles in tests."""
    return rounded(t_statistic(_matched(spark, sf_dir), "n_delta", ["entity"]).drop("p_value"))


@query(
    "baseline_ratio",
    f"""WITH {HISTORY} SELECT entity, round(avg(n_events), 6) AS mean_actual, round(avg(n_same_hour_7d), 6) AS mean_baseline,
      round(avg(n_same_hour_7d) / avg(n_events), 6) AS ratio, avg(n_same_hour_7d) / avg(n_events) BETWEEN 0.95 AND 1.05 AS sound
    FROM hist WHERE n_lag_168h IS NOT NULL GROUP BY entity""",
)
def baseline(spark, sf_dir):
    return rounded(
        baseline_ratio(
            history_table(spark, sf_dir),
            "n_events",
            "n_same_hour_7d",
            ["entity"],
            F.col("has_count_history"),
        )
    )


EVENT_DAY = (
    HISTORY
    + """,
day AS (SELECT date FROM (SELECT date, avg(mean_value) AS i FROM hist WHERE date >= DATE '2024-01-08' GROUP BY date) ORDER BY i DESC, date LIMIT 1),
marked AS (SELECT h.*, d.date AS event_date FROM hist h, day d WHERE h.date >= DATE '2024-01-08')"""
)


def _later(spark, sf_dir):
    """The grid-sized table is staged, as the day and the comparison both read it."""
    table = stage(history_table(spark, sf_dir))
    return table.where(F.col("date") >= F.lit("2024-01-08").cast("date"))


@query(
    "event_day",
    f"""WITH {EVENT_DAY}, a AS (SELECT max(event_date) AS event_date, CAST(sum(n_events) FILTER (date = event_date) AS DOUBLE) AS observed,
      sum(n_same_hour_7d) FILTER (date = event_date) AS trailing_norm,
      CAST(sum(n_events) FILTER (date <> event_date AND abs(date - event_date) <= 28 AND isodow(date) = isodow(event_date)) AS DOUBLE)
        / count(DISTINCT date) FILTER (date <> event_date AND abs(date - event_date) <= 28 AND isodow(date) = isodow(event_date)) AS seasonal_norm,
      count(DISTINCT date) FILTER (date <> event_date AND abs(date - event_date) <= 28 AND isodow(date) = isodow(event_date)) AS seasonal_days FROM marked)
    SELECT event_date, observed, round(trailing_norm, 6) AS trailing_norm, round(100 * (observed / trailing_norm - 1), 6) AS vs_trailing_pct,
      round(seasonal_norm, 6) AS seasonal_norm, round(100 * (observed / seasonal_norm - 1), 6) AS vs_seasonal_pct, seasonal_days FROM a""",
)
def event_day(spark, sf_dir):
    return rounded(
        event_day_compare(_later(spark, sf_dir), "mean_value", "n_events", "n_same_hour_7d")
    )


@query(
    "event_day_profile",
    f"""WITH {EVENT_DAY} SELECT entity, hour, CAST(sum(n_events) FILTER (date = event_date) AS BIGINT) AS observed,
      round(avg(n_events) FILTER (date <> event_date AND abs(date - event_date) <= 28 AND isodow(date) = isodow(event_date)), 6) AS seasonal_mean
    FROM marked GROUP BY 1, 2""",
)
def event_profile(spark, sf_dir):
    return rounded(
        event_day_profile(_later(spark, sf_dir), "mean_value", "n_events", ["entity", "hour"])
    )


# Orders as trips to the customer's nation; priority stands for the origin.
FLOWS = """
flows AS (SELECT o_orderpriority AS origin, c_nationkey AS zone, o_orderstatus = 'F' AS is_night, count(*) AS trips, sum(o_totalprice) AS sum_price
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3)"""


def _flows(spark, sf_dir):
    """Flows to nations: orders collapse per customer before the customer join."""
    orders = study.table(spark, sf_dir, "orders")
    per_customer = zone_flows(
        orders.select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderpriority").alias("origin"),
            (F.col("o_orderstatus") == "F").alias("is_night"),
            "o_totalprice",
        ),
        ["c_custkey", "origin", "is_night"],
        {"sum_price": F.col("o_totalprice")},
    )
    homes = study.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("zone")
    )
    joined = per_customer.join(homes, on="c_custkey", how="left")
    return joined.groupBy("origin", "zone", "is_night").agg(
        F.sum("trips").alias("trips"), F.sum("sum_price").alias("sum_price")
    )


@query("zone_flows", f"WITH {FLOWS} SELECT origin, zone, is_night, trips, round(sum_price, 2) AS sum_price FROM flows")
def flows(spark, sf_dir):
    return rounded(_flows(spark, sf_dir), 2)


@query(
    "regrouped_means",
    f"""WITH {FLOWS} SELECT zone, CAST(sum(trips) AS BIGINT) AS trips, round(sum(sum_price), 2) AS sum_price, round(sum(sum_price) / sum(trips), 2) AS mean_price FROM flows GROUP BY zone""",
)
def regrouped(spark, sf_dir):
    return rounded(regroup_means(_flows(spark, sf_dir), ["zone"], ["sum_price"]), 2)


@query(
    "group_share",
    f"""WITH {FLOWS}, c AS (SELECT origin, zone, sum(trips) AS trips FROM flows GROUP BY 1, 2)
    SELECT origin, zone, CAST(trips AS BIGINT) AS trips, round(100.0::DOUBLE * trips / sum(trips) OVER (PARTITION BY origin), 6) AS share_pct FROM c""",
)
def shares(spark, sf_dir):
    return rounded(group_share(_flows(spark, sf_dir), "trips", ["origin", "zone"], ["origin"]))


@query(
    "unknown_share",
    f"""WITH {FLOWS} SELECT round(100.0::DOUBLE * sum(trips) FILTER (zone IN (23, 24)) / sum(trips), 6) AS unknown_share_pct FROM flows""",
)
def unknown_share(spark, sf_dir):
    by_zone = group_share(_flows(spark, sf_dir), "trips", ["zone"], [])
    unknown = F.when(F.col("zone").isin(23, 24), F.col("share_pct"))
    return rounded(by_zone.agg(F.sum(unknown).alias("unknown_share_pct")))


@query(
    "mix_shift",
    f"""WITH {FLOWS}, c AS (SELECT zone, sum(CASE WHEN is_night THEN trips ELSE 0 END) AS a, sum(CASE WHEN NOT is_night THEN trips ELSE 0 END) AS b FROM flows GROUP BY zone)
    SELECT zone, CAST(a AS BIGINT) AS on_amount, CAST(b AS BIGINT) AS off_amount,
      round(100.0::DOUBLE * a / sum(a) OVER () - 100.0::DOUBLE * b / sum(b) OVER (), 6) AS shift_pp FROM c""",
)
def mix(spark, sf_dir):
    return rounded(mix_shift(_flows(spark, sf_dir), "zone", F.col("is_night"), F.col("trips")))


@query(
    "zone_table",
    """WITH f AS (SELECT c_nationkey AS zone, count(*) AS trips, sum(o_totalprice) AS sum_price, sum(20.0::DOUBLE + o_totalprice % 40) AS sum_minutes
      FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1),
    s AS (SELECT s_nationkey AS zone, count(*) AS supply FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
    SELECT f.zone, n_name, trips, round(sum_price, 2) AS sum_price, round(sum_minutes, 2) AS sum_minutes, round(sum_price / trips, 2) AS mean_price,
      round(sum_minutes / trips, 2) AS mean_minutes, round(supply / 57600.0::DOUBLE, 6) AS supply_per_hour,
      round((sum_price / trips) / (sum_minutes / trips / 60.0::DOUBLE), 2) AS revenue_per_engaged_hour
    FROM f LEFT JOIN nation ON n_nationkey = f.zone LEFT JOIN s ON s.zone = f.zone""",
)
def zones(spark, sf_dir):
    """Revenue per engaged hour of each nation beside its own supply rate."""
    orders = study.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        "o_totalprice",
        (F.lit(20.0) + F.col("o_totalprice") % 40).alias("minutes"),
    )
    per_customer = zone_flows(
        orders, ["c_custkey"], {"sum_price": F.col("o_totalprice"), "sum_minutes": F.col("minutes")}
    )
    homes = study.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("zone")
    )
    supplied = study.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    supply = (
        supplied.join(
            study.table(spark, sf_dir, "supplier").select(
                F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("zone")
            ),
            on="l_suppkey",
            how="left",
        )
        .groupBy("zone")
        .agg(F.sum("n").alias("supply_count"))
    )
    nations = study.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("zone"), "n_name")
    table = zone_table(
        per_customer.join(homes, on="c_custkey", how="left"),
        nations,
        supply,
        "zone",
        57600.0,
        "sum_price",
        "sum_minutes",
    )
    money = ["sum_price", "sum_minutes", "mean_price", "mean_minutes", "revenue_per_engaged_hour"]
    return table.select(
        "zone",
        "n_name",
        "trips",
        F.round("supply_per_hour", 6).alias("supply_per_hour"),
        *[F.round(c, 2).alias(c) for c in money],
    )


@query(
    "entity_columns",
    f"""WITH {HOURS} SELECT hour, round(avg(mean_value) FILTER (entity = 'purchase'), 6) AS purchase, round(avg(mean_value) FILTER (entity = 'signup'), 6) AS signup FROM hours GROUP BY hour""",
)
def side_by_side(spark, sf_dir):
    return rounded(
        entity_columns(entity_hours(spark, sf_dir), ["hour"], "entity", ["purchase", "signup"], "mean_value")
    )


@query(
    "arg_extreme",
    f"""WITH {HOURS} SELECT entity, date, hour, n_events FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY n_events DESC, date, hour) AS k FROM hours) WHERE k = 1""",
)
def largest_cell(spark, sf_dir):
    return arg_extreme(entity_hours(spark, sf_dir), ["entity"], "n_events", ["date", "hour"])
