"""Distributions, fences, spectra, dispersion, matrices and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.functions.calendar import iso_weekday
from tidegrid.functions.columns import in_wrapped_range
from tidegrid.operators.profile import (
    binned_spectrum,
    dispersion,
    dispersion_summary,
    distribution_flags,
    distribution_summary,
    mass_point,
    modes,
    profile_extremes,
    quantile_bins,
    rank_gap,
    spearman,
    tukey_fences,
    upper_fence,
    value_spectrum,
)
from tidegrid.operators.reshape import (
    matrix_to_long,
    top_k,
    union_picks,
    weekday_hour_matrix,
)
from tidegrid.plans import study
from tidegrid.plans.entity_hours import entity_hours

SEGMENTS_SQL = (
    ("all", "true"),
    ("returned", "l_returnflag = 'R'"),
    ("open", "l_linestatus = 'O'"),
)
METRICS_SQL = (
    ("price", "l_extendedprice"),
    ("unit_price", "l_extendedprice / l_quantity"),
    ("open_discount", "CASE WHEN l_linestatus = 'O' THEN l_discount END"),
)


def _segments():
    return {
        "all": F.lit(True),
        "returned": F.col("l_returnflag") == "R",
        "open": F.col("l_linestatus") == "O",
    }


def _metrics():
    return {
        "price": F.col("l_extendedprice"),
        "unit_price": F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        "open_discount": F.when(F.col("l_linestatus") == "O", F.col("l_discount")),
    }


def _melted() -> str:
    parts = [
        f"SELECT '{s}' AS segment, '{m}' AS metric, {x} AS v FROM lineitem WHERE {p}"
        for s, p in SEGMENTS_SQL
        for m, x in METRICS_SQL
    ]
    return "melted AS (" + " UNION ALL ".join(parts) + "), filled AS (SELECT * FROM melted WHERE v IS NOT NULL)"


# The population skewness is written from central moments.
SUMMARY = f"""
{_melted()},
mean0 AS (SELECT segment, metric, avg(v) AS mu FROM filled GROUP BY 1, 2),
summary AS (
  SELECT f.segment, f.metric, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS sd,
    avg(pow(v - mu, 3)) / pow(avg(pow(v - mu, 2)), 1.5) AS skew, max(v) AS max,
    quantile_disc(v, 0.01) AS p1, quantile_disc(v, 0.05) AS p5, quantile_disc(v, 0.25) AS p25, quantile_disc(v, 0.5) AS p50,
    quantile_disc(v, 0.75) AS p75, quantile_disc(v, 0.95) AS p95, quantile_disc(v, 0.99) AS p99, quantile_disc(v, 0.999) AS p99_9
  FROM filled f JOIN mean0 m ON m.segment = f.segment AND m.metric = f.metric GROUP BY 1, 2)"""
PCTS = ", ".join(f"round({p}, 4) AS {p}" for p in ("p1", "p5", "p25", "p50", "p75", "p95", "p99", "p99_9"))


def _lines(spark, sf_dir):
    return study.table(spark, sf_dir, "lineitem")


@query(
    "distribution",
    f"""WITH {SUMMARY} SELECT segment, metric, n, round(mean, 4) AS mean, round(sd, 4) AS sd, round(skew, 4) AS skew, round(max, 4) AS max, {PCTS} FROM summary""",
)
def distribution(spark, sf_dir):
    return rounded(distribution_summary(_lines(spark, sf_dir), _segments(), _metrics()), 4)


@query("distribution_sketched")
def distribution_sketched(spark, sf_dir):
    """The same table with sketched percentiles, all in one pass."""
    return rounded(
        distribution_summary(_lines(spark, sf_dir), _segments(), _metrics(), accuracy=20_000), 4
    )


@query(
    "distribution_flags",
    f"""WITH {SUMMARY} SELECT segment, metric, round(pow(max - mean, 2) / (n * pow(sd, 2)), 8) AS max_share_of_variance,
      abs(p99_9 - max) <= 1e-8 + 1e-5 * abs(max) AS tail_unresolved, pow(max - mean, 2) / (n * pow(sd, 2)) > 0.1 AS variance_dominated FROM summary""",
)
def flags(spark, sf_dir):
    summary = distribution_summary(
        _lines(spark, sf_dir), _segments(), _metrics(), percentiles={"p99_9": 0.999}
    )
    return rounded(
        distribution_flags(summary).select(
            "segment", "metric", "max_share_of_variance", "tail_unresolved", "variance_dominated"
        ),
        8,
    )


@query(
    "tukey_fences",
    f"""WITH {SUMMARY}, f AS (SELECT segment, metric, p25, p50, p75, p75 + 1.5::DOUBLE * (p75 - p25) AS upper_fence FROM summary),
    a AS (SELECT m.segment, m.metric, count(*) AS n, count(*) FILTER (v > upper_fence) AS n_above_fence FROM filled m
          JOIN f ON f.segment = m.segment AND f.metric = m.metric GROUP BY 1, 2)
    SELECT f.segment, f.metric, round(p25, 4) AS p25, round(p50, 4) AS p50, round(p75, 4) AS p75, round(upper_fence, 4) AS upper_fence, n, n_above_fence,
      round(100.0::DOUBLE * n_above_fence / n, 4) AS pct_above_fence FROM f JOIN a ON a.segment = f.segment AND a.metric = f.metric""",
)
def fences(spark, sf_dir):
    return rounded(tukey_fences(_lines(spark, sf_dir), _segments(), _metrics()), 4)


@query(
    "extremes",
    """WITH q AS (SELECT quantile_disc(o_totalprice, 0.25) AS a, quantile_disc(o_totalprice, 0.75) AS b FROM orders),
    x AS (SELECT o.* FROM orders o, q WHERE o_totalprice > b + 0.25::DOUBLE * (b - a)),
    c AS (SELECT o_orderpriority, n_name, count(*) AS row_count, avg(o_totalprice) AS mean_price FROM x
          LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
    SELECT o_orderpriority, n_name, row_count, round(mean_price * row_count, 2) AS price_in_group,
      round(100.0::DOUBLE * row_count / sum(row_count) OVER (), 6) AS pct_of_extremes FROM c""",
)
def extremes(spark, sf_dir):
    orders = study.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_totalprice"
    )
    nations = study.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    homes = study.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(
        nations, on="c_nationkey", how="left"
    )
    fence = upper_fence(orders, F.col("o_totalprice"), k=0.25)
    out = profile_extremes(
        orders,
        F.col("o_totalprice") > fence,
        "c_custkey",
        homes.select("c_custkey", "n_name"),
        ["o_orderpriority", "n_name"],
        {"mean_price": "o_totalprice"},
    )
    return out.select(
        "o_orderpriority",
        "n_name",
        "row_count",
        # The mean times its rows is whole cents, which round alike in any engine.
        F.round(F.col("mean_price") * F.col("row_count"), 2).alias("price_in_group"),
        F.round("pct_of_extremes", 6).alias("pct_of_extremes"),
    )


SPECTRUM = """
spectrum AS (
  SELECT round(value, 0) AS value, count(*) AS row_count, count(*) FILTER (event_type = 'purchase') AS purchases,
    count(*) FILTER (hour(ts) >= 22 OR hour(ts) < 6) AS night FROM events GROUP BY 1)"""


def _spectrum(spark, sf_dir):
    events = study.table(spark, sf_dir, "events").select("value", "event_type", F.hour("ts").alias("hour"))
    segments = {
        "purchases": F.col("event_type") == "purchase",
        "night": in_wrapped_range("hour", 22, 6),
    }
    return value_spectrum(events, F.col("value"), segments, digits=0)


@query("value_spectrum", f"WITH {SPECTRUM} SELECT * FROM spectrum")
def spectrum(spark, sf_dir):
    return _spectrum(spark, sf_dir)


@query(
    "modes",
    f"""WITH {SPECTRUM}, r AS (
      SELECT 'purchases' AS segment, value, purchases AS n, row_number() OVER (ORDER BY purchases DESC, value) AS k, sum(purchases) OVER () AS t FROM spectrum
      UNION ALL SELECT 'night', value, night, row_number() OVER (ORDER BY night DESC, value), sum(night) OVER () FROM spectrum)
    SELECT segment, value AS mode, n AS mode_rows, CAST(t AS BIGINT) AS segment_rows, round(100.0::DOUBLE * n / t, 6) AS mode_pct FROM r WHERE k = 1""",
)
def modal(spark, sf_dir):
    return rounded(modes(_spectrum(spark, sf_dir), ["purchases", "night"]))


@query(
    "mass_point",
    f"""WITH {SPECTRUM} SELECT 'purchases' AS segment, CAST(sum(purchases) FILTER (value = 10) AS BIGINT) AS rows_at_point,
      round(100.0::DOUBLE * (sum(purchases) FILTER (value = 10)) / sum(purchases), 6) AS pct_at_point FROM spectrum
    UNION ALL SELECT 'night', CAST(sum(night) FILTER (value = 10) AS BIGINT), round(100.0::DOUBLE * (sum(night) FILTER (value = 10)) / sum(night), 6) FROM spectrum""",
)
def mass(spark, sf_dir):
    return rounded(mass_point(_spectrum(spark, sf_dir), 10.0, ["purchases", "night"]))


@query(
    "binned_spectrum",
    f"""WITH {SPECTRUM}, t AS (SELECT sum(row_count) AS r, sum(purchases) AS p FROM spectrum),
    b AS (SELECT floor(value / 5.0::DOUBLE) * 5.0::DOUBLE AS bin, CAST(sum(row_count) AS BIGINT) AS row_count, CAST(sum(purchases) AS BIGINT) AS purchases
          FROM spectrum WHERE value <= 120 GROUP BY 1)
    SELECT bin, row_count, purchases, round(100.0::DOUBLE * row_count / r, 6) AS row_count_pct, round(100.0::DOUBLE * purchases / p, 6) AS purchases_pct FROM b, t""",
)
def binned(spark, sf_dir):
    return rounded(binned_spectrum(_spectrum(spark, sf_dir), 5.0, 120.0, ["row_count", "purchases"]))


@query(
    "dispersion",
    f"""WITH {HOURS} SELECT entity, hour, round(avg(n_events), 6) AS mean, round(var_samp(n_events), 6) AS variance, count(*) AS days,
      round(CASE WHEN avg(n_events) > 0 THEN var_samp(n_events) / avg(n_events) END, 6) AS dispersion FROM hours GROUP BY 1, 2""",
)
def dispersed(spark, sf_dir):
    return rounded(dispersion(entity_hours(spark, sf_dir), ["entity", "hour"], "n_events"))


@query(
    "dispersion_summary",
    f"""WITH {HOURS}, c AS (SELECT entity, hour, var_samp(n_events) / avg(n_events) AS d FROM hours GROUP BY 1, 2)
    SELECT entity, round(min(d), 6) AS min_dispersion, round(max(d), 6) AS max_dispersion, count(*) FILTER (d > 1) AS overdispersed_cells,
      count(*) AS cells, round(quantile_cont(d, 0.5), 6) AS median_dispersion FROM c GROUP BY entity""",
)
def dispersed_summary(spark, sf_dir):
    cells = dispersion(entity_hours(spark, sf_dir), ["entity", "hour"], "n_events")
    return rounded(dispersion_summary(cells, ["entity"]))


MATRIX = (
    HOURS
    + """,
cells AS (SELECT entity, CAST(isodow(date) AS INTEGER) AS day_of_week, hour, avg(n_events) AS mean_events, avg(mean_value) AS mean_value FROM hours GROUP BY 1, 2, 3)"""
)


def _cells(spark, sf_dir):
    hours = entity_hours(spark, sf_dir).select("*", iso_weekday("date").alias("day_of_week"))
    return hours.groupBy("entity", "day_of_week", "hour").agg(
        F.avg("n_events").alias("mean_events"), F.avg("mean_value").alias("mean_value")
    )


@query(
    "weekday_hour_matrix",
    f"""WITH {MATRIX} SELECT entity, day_of_week, """
    + ", ".join(
        f"round(max(CASE WHEN hour = {h} THEN mean_events END), 6) AS h{h:02d}" for h in range(24)
    )
    + " FROM cells GROUP BY 1, 2",
)
def matrix(spark, sf_dir):
    hours = entity_hours(spark, sf_dir).select("*", iso_weekday("date").alias("day_of_week"))
    return rounded(weekday_hour_matrix(hours, "n_events", ["entity"]))


@query(
    "matrix_long",
    f"WITH {MATRIX} SELECT entity, day_of_week, hour, round(mean_value, 9) AS mean_value FROM cells",
)
def matrix_long(spark, sf_dir):
    hours = entity_hours(spark, sf_dir).select("*", iso_weekday("date").alias("day_of_week"))
    wide = weekday_hour_matrix(hours, "mean_value", ["entity"])
    return rounded(matrix_to_long(wide, ["entity", "day_of_week"], "mean_value"), 9)


@query(
    "rank_gap",
    f"""WITH {MATRIX}, c AS (SELECT entity, day_of_week, hour, round(mean_events, 9) AS mean_events, round(mean_value, 9) AS mean_value FROM cells),
    r AS (SELECT *,
      (rank() OVER (PARTITION BY entity ORDER BY mean_events) + (count(*) OVER (PARTITION BY entity, mean_events) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY entity) AS a,
      (rank() OVER (PARTITION BY entity ORDER BY mean_value) + (count(*) OVER (PARTITION BY entity, mean_value) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY entity) AS b
      FROM c WHERE mean_value IS NOT NULL)
    SELECT entity, day_of_week, hour, mean_events, mean_value, round(a, 9) AS mean_events_rank, round(b, 9) AS mean_value_rank, round(b - a, 9) AS rank_gap FROM r""",
)
def gaps(spark, sf_dir):
    cells = rounded(_cells(spark, sf_dir), 9).where(F.col("mean_value").isNotNull())
    return rounded(rank_gap(cells, "mean_value", "mean_events", ["entity"]), 9)


@query(
    "spearman",
    f"""WITH {MATRIX}, c AS (SELECT entity, round(mean_events, 9) AS x, round(mean_value, 9) AS y FROM cells WHERE mean_value IS NOT NULL),
    r AS (SELECT entity,
      rank() OVER (PARTITION BY entity ORDER BY x) + (count(*) OVER (PARTITION BY entity, x) - 1) / 2.0::DOUBLE AS a,
      rank() OVER (PARTITION BY entity ORDER BY y) + (count(*) OVER (PARTITION BY entity, y) - 1) / 2.0::DOUBLE AS b FROM c)
    SELECT entity, round(corr(a, b), 9) AS spearman, count(*) AS n FROM r GROUP BY entity""",
)
def rank_correlation(spark, sf_dir):
    return rounded(spearman(rounded(_cells(spark, sf_dir), 9), "mean_events", "mean_value", ["entity"]), 9)


@query(
    "picks_union",
    f"""WITH {MATRIX}, c AS (SELECT entity, day_of_week, hour, round(mean_events, 9) AS mean_events, round(mean_value, 9) AS mean_value FROM cells WHERE mean_value IS NOT NULL)
    (SELECT * FROM c ORDER BY mean_events DESC, entity, day_of_week, hour LIMIT 6)
    UNION (SELECT * FROM c ORDER BY mean_value DESC, entity, day_of_week, hour LIMIT 6)
    UNION (SELECT * FROM c ORDER BY mean_value, entity, day_of_week, hour LIMIT 6)""",
)
def picks(spark, sf_dir):
    cells = rounded(_cells(spark, sf_dir), 9).where(F.col("mean_value").isNotNull())
    keys = [F.col(c) for c in ("entity", "day_of_week", "hour")]
    chosen = [
        top_k(cells, [F.desc("mean_events"), *keys], 6),
        top_k(cells, [F.desc("mean_value"), *keys], 6),
        top_k(cells, [F.asc("mean_value"), *keys], 6),
    ]
    return union_picks(chosen, ["entity", "day_of_week", "hour"])


@query(
    "quantile_bins",
    """WITH q AS (SELECT unnest(quantile_cont(o_totalprice, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS edge FROM orders),
    b AS (SELECT o_totalprice, greatest((SELECT count(*) FROM q WHERE edge < o_totalprice), 1) AS bin FROM orders)
    SELECT CAST(bin AS INTEGER) AS bin, count(*) AS row_count, round(min(o_totalprice), 4) AS lowest, round(max(o_totalprice), 4) AS highest FROM b GROUP BY bin""",
)
def deciles(spark, sf_dir):
    binned_orders = quantile_bins(study.table(spark, sf_dir, "orders"), "o_totalprice", 10)
    return rounded(
        binned_orders.groupBy("bin").agg(
            F.count("*").alias("row_count"),
            F.min("o_totalprice").alias("lowest"),
            F.max("o_totalprice").alias("highest"),
        ),
        4,
    )
