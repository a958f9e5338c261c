"""Benchmarks, losses, bias diagnosis and expected revenue, on naive predictions.

Naive predictions are plain columns, so every figure here has an oracle; the fitted models go
through the same operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.history_queries import HISTORY
from tidegrid.catalog.registry import query, rounded
from tidegrid.operators.evaluate import (
    attribute_bias,
    attribution_summary,
    autocorrelation,
    best_hours,
    bias_by_bin,
    bias_shape,
    combine_revenue,
    comparison,
    crossover,
    error_metrics,
    horizon_decay,
    level_shift,
    naive_benchmark,
    peak_and_trough,
    poisson_deviance,
    profile_shape,
    residual_covariance,
    residual_report,
    score_common,
    sign_share,
    surface,
    winner_per_loss,
    worst_rows,
)
from tidegrid.plans.forecasts import naive_table
from tidegrid.plans.model_table import history_table

NAIVE = (
    HISTORY
    + """,
naive AS (SELECT *, n_same_hour_7d + 0.5::DOUBLE AS pred_n, coalesce(value_lag_168h, value_same_hour_7d) AS pred_value,
  n_events - (n_same_hour_7d + 0.5::DOUBLE) AS residual FROM hist WHERE n_lag_168h IS NOT NULL),
test AS (SELECT * FROM naive WHERE split = 'test')"""
)


def _test(spark, sf_dir):
    return naive_table(spark, sf_dir).where(F.col("split") == "test")


@query(
    "naive_benchmark",
    f"""WITH {NAIVE} SELECT 'count' AS target, count(n_events - n_lag_168h) AS n, round(sqrt(avg(pow(n_events - n_lag_168h, 2))), 6) AS rmse, round(avg(abs(n_events - n_lag_168h)), 6) AS mae FROM test
    UNION ALL SELECT 'value', count(mean_value - value_lag_168h), round(sqrt(avg(pow(mean_value - value_lag_168h, 2))), 6), round(avg(abs(mean_value - value_lag_168h)), 6) FROM test""",
)
def benchmark(spark, sf_dir):
    pairs = {"count": ("n_events", "n_lag_168h"), "value": ("mean_value", "value_lag_168h")}
    return rounded(naive_benchmark(_test(spark, sf_dir), pairs))


@query(
    "error_metrics",
    f"""WITH {NAIVE} SELECT entity, split, count(mean_value - pred_value) AS n, round(sqrt(avg(pow(mean_value - pred_value, 2))), 6) AS rmse,
      round(avg(abs(mean_value - pred_value)), 6) AS mae FROM naive GROUP BY 1, 2""",
)
def errors(spark, sf_dir):
    rows = naive_table(spark, sf_dir)
    return rounded(error_metrics(rows, "mean_value", "pred_value", ["entity", "split"]))


@query(
    "comparison",
    f"""WITH {NAIVE}, r AS (
      SELECT 'count' AS target, 'last week' AS model, n_events - n_lag_168h AS e FROM test UNION ALL
      SELECT 'count', 'trailing mean', n_events - pred_n FROM test UNION ALL
      SELECT 'value', 'last week', mean_value - value_lag_168h FROM test UNION ALL
      SELECT 'value', 'fallback', CASE WHEN value_lag_168h IS NOT NULL THEN mean_value - pred_value END FROM test UNION ALL
      SELECT 'value', 'fallback, full support', mean_value - pred_value FROM test)
    SELECT target, model, count(e) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae FROM r GROUP BY 1, 2""",
)
def compared(spark, sf_dir):
    common = F.col("value_lag_168h").isNotNull()
    rows = [
        ("count", "last week", "n_events", "n_lag_168h", None),
        ("count", "trailing mean", "n_events", "pred_n", None),
        ("value", "last week", "mean_value", "value_lag_168h", None),
        ("value", "fallback", "mean_value", "pred_value", common),
        ("value", "fallback, full support", "mean_value", "pred_value", None),
    ]
    return rounded(comparison(_test(spark, sf_dir), rows))


@query(
    "score_common",
    f"""WITH {NAIVE}, e AS (SELECT mean_value - value_same_hour_7d AS f, mean_value - value_lag_168h AS b FROM test),
    a AS (SELECT count(b) AS n_benchmark, sqrt(avg(b * b)) AS benchmark_rmse, count(f) FILTER (b IS NOT NULL) AS n_common, sqrt(avg(f * f) FILTER (b IS NOT NULL)) AS common_rmse,
      count(f) AS n_full, sqrt(avg(f * f)) AS full_rmse, count(f) FILTER (b IS NULL) AS n_dropped, sqrt(avg(f * f) FILTER (b IS NULL)) AS dropped_rmse FROM e)
    SELECT n_benchmark, round(benchmark_rmse, 6) AS benchmark_rmse, n_common, round(common_rmse, 6) AS common_rmse, n_full, round(full_rmse, 6) AS full_rmse, n_dropped,
      round(dropped_rmse, 6) AS dropped_rmse, round(100 * (1 - common_rmse / benchmark_rmse), 6) AS improvement_pct FROM a""",
)
def common(spark, sf_dir):
    return rounded(score_common(_test(spark, sf_dir), "mean_value", "value_same_hour_7d", "value_lag_168h"))


@query(
    "poisson_deviance",
    f"""WITH {NAIVE} SELECT entity, round(2 * avg(CASE WHEN n_events > 0 THEN n_events * ln(n_events / pred_n) ELSE 0 END - (n_events - pred_n)), 6) AS trailing,
      round(2 * avg(CASE WHEN n_events > 0 THEN n_events * ln(n_events / (n_lag_168h + 0.5::DOUBLE)) ELSE 0 END - (n_events - (n_lag_168h + 0.5::DOUBLE))), 6) AS last_week FROM test GROUP BY entity""",
)
def deviance(spark, sf_dir):
    rows = _test(spark, sf_dir).select("*", (F.col("n_lag_168h") + 0.5).alias("shifted"))
    fitted = {"trailing": "pred_n", "last_week": "shifted"}
    return rounded(poisson_deviance(rows, "n_events", fitted, ["entity"]))


@query(
    "winner_per_loss",
    f"""WITH {NAIVE}, l AS (SELECT sqrt(avg(pow(n_events - pred_n, 2))) AS a, sqrt(avg(pow(n_events - n_lag_168h, 2))) AS b, avg(abs(n_events - pred_n)) AS c, avg(abs(n_events - n_lag_168h)) AS d FROM test)
    SELECT CASE WHEN a <= b THEN 'a trailing' ELSE 'b last week' END AS rmse_winner, CASE WHEN c <= d THEN 'a trailing' ELSE 'b last week' END AS mae_winner, (a <= b) = (c <= d) AS losses_agree FROM l""",
)
def winner(spark, sf_dir):
    losses = comparison(
        _test(spark, sf_dir),
        [
            ("count", "a trailing", "n_events", "pred_n", None),
            ("count", "b last week", "n_events", "n_lag_168h", None),
        ],
    )
    return winner_per_loss(losses, "model", ["rmse", "mae"])


@query(
    "residual_covariance",
    f"""WITH {NAIVE}, a AS (SELECT count((n_events - pred_n) * (mean_value - pred_value)) AS n_defined, avg((n_events - pred_n) * (mean_value - pred_value)) AS covariance,
      avg(sum_value) AS mean_observed, (sum(sum_value) - sum(pred_n * pred_value)) / count(*) AS shortfall_per_hour FROM test)
    SELECT n_defined, round(covariance, 6) AS covariance, round(mean_observed, 6) AS mean_observed, round(shortfall_per_hour, 6) AS shortfall_per_hour,
      round(100 * covariance / mean_observed, 6) AS share_of_level_pct, round(100 * covariance / shortfall_per_hour, 6) AS share_of_shortfall_pct FROM a""",
)
def covariance(spark, sf_dir):
    return rounded(
        residual_covariance(
            _test(spark, sf_dir), ("n_events", "pred_n"), ("mean_value", "pred_value"), "sum_value"
        )
    )


@query(
    "bias_by_cell",
    f"""WITH {NAIVE} SELECT entity, hour, round(avg(residual), 6) AS mean_error, round(avg(abs(residual)), 6) AS mean_abs_error, count(residual) AS n FROM test GROUP BY 1, 2""",
)
def bias_cells(spark, sf_dir):
    return rounded(residual_report(_test(spark, sf_dir), "residual", ["entity", "hour"]))


@query(
    "sign_share",
    f"""WITH {NAIVE}, c AS (SELECT entity, hour, avg(residual) AS e FROM test GROUP BY 1, 2)
    SELECT count(*) AS cells, count(*) FILTER (round(e, 9) > 0) AS positive_cells, round(avg(CASE WHEN round(e, 9) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_positive FROM c""",
)
def signs(spark, sf_dir):
    cells = residual_report(_test(spark, sf_dir), "residual", ["entity", "hour"])
    return rounded(sign_share(rounded(cells, 9)))


@query(
    "worst_days",
    f"""WITH {NAIVE}, d AS (SELECT date, round(avg(residual), 6) AS mean_error, round(avg(abs(residual)), 6) AS mean_abs_error, count(residual) AS n FROM test GROUP BY date)
    SELECT * FROM d ORDER BY mean_abs_error DESC, date LIMIT 5""",
)
def worst_days(spark, sf_dir):
    days = rounded(residual_report(_test(spark, sf_dir), "residual", ["date"]))
    return worst_rows(days, F.col("mean_abs_error"), ["date"], 5)


@query(
    "autocorrelation",
    f"""WITH {HISTORY}, r AS (SELECT entity, date, hour, CASE WHEN n_lag_168h IS NOT NULL AND split = 'test' THEN n_events - n_lag_168h END AS r FROM hist),
    p AS (SELECT entity, r, lag(r) OVER (PARTITION BY entity ORDER BY date, hour) AS q FROM r)
    SELECT entity, round(corr(r, q), 6) AS autocorrelation, count(r + q) AS pairs FROM p GROUP BY entity""",
)
def autocorr(spark, sf_dir):
    rows = history_table(spark, sf_dir)
    residual = F.col("n_events") - F.col("n_lag_168h")
    return rounded(autocorrelation(rows, residual, ["entity"], keep=F.col("split") == "test"))


@query(
    "level_shift",
    f"""WITH {HISTORY}, s AS (SELECT * FROM hist WHERE day_of_week IN (SELECT day_of_week FROM hist WHERE split = 'test')),
    a AS (SELECT entity, avg(n_events) FILTER (split = 'train') AS tr, avg(n_events) FILTER (split = 'test') AS te FROM s GROUP BY entity)
    SELECT entity, round(tr, 6) AS train_level, round(te, 6) AS test_level, round(100 * (te / tr - 1), 6) AS change_pct FROM a""",
)
def levels(spark, sf_dir):
    rows = history_table(spark, sf_dir)
    return rounded(level_shift(rows, "n_events", ["entity"], "split", ["day_of_week"]))


BINS = (
    NAIVE
    + """,
edges AS (SELECT DISTINCT unnest(quantile_cont(pred_n, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS edge FROM test),
binned AS (SELECT *, greatest((SELECT count(*) FROM edges WHERE edge < pred_n), 1) AS bin FROM test),
profile AS (SELECT CAST(bin AS INTEGER) AS bin, avg(pred_n) AS mean_predicted, avg(n_events) AS mean_observed, avg(residual) AS mean_error, count(*) AS n FROM binned GROUP BY 1)"""
)


@query(
    "bias_by_bin",
    f"""WITH {BINS} SELECT bin, round(mean_predicted, 6) AS mean_predicted, round(mean_observed, 6) AS mean_observed, round(mean_error, 6) AS mean_error, n FROM profile""",
)
def bins(spark, sf_dir):
    return rounded(bias_by_bin(_test(spark, sf_dir), "pred_n", "n_events", "residual", 10))


LINE = """count(*) AS n, avg(y) AS m, avg(y * y) AS q, var_pop(y) AS vy, avg(x) AS mx, var_pop(x) AS vx, covar_pop(y, x) AS c, min(x) AS x0, max(x) AS x1"""
SLOPE_SE = "sqrt(greatest(vy - c / vx * c, 0) / ((n - 2) * vx))"


@query(
    "bias_shape",
    f"""WITH {BINS}, l AS (SELECT {LINE} FROM (SELECT residual AS y, pred_n AS x FROM test)),
    k AS (SELECT rank() OVER (ORDER BY mean_error) + (count(*) OVER (PARTITION BY mean_error) - 1) / 2.0 AS a, rank() OVER (ORDER BY mean_predicted) + (count(*) OVER (PARTITION BY mean_predicted) - 1) / 2.0 AS b FROM profile),
    r AS (SELECT (SELECT stddev_samp(mean_error) FROM profile) AS bin_scatter, (SELECT bin FROM profile ORDER BY abs(mean_error) DESC, bin LIMIT 1) AS peak_bin,
      (SELECT mean_error FROM profile ORDER BY bin LIMIT 1) AS quietest_error, (SELECT mean_error FROM profile ORDER BY bin DESC LIMIT 1) AS busiest_error,
      (SELECT corr(a, b) FROM k) AS trend, (SELECT avg(residual) FROM test) AS mean_bias,
      (SELECT 100 * (avg(n_events) FILTER (split = 'test') / avg(n_events) FILTER (split = 'train') - 1) FROM hist) AS level_change_pct)
    SELECT n, round(m, 6) AS mean_error, round(c / vx, 6) AS slope, round({SLOPE_SE}, 6) AS slope_se, round(m * m / q, 6) AS level_share, round(c / vx * c / q, 6) AS slope_share,
      CASE WHEN greatest(m * m / q, c / vx * c / q) < 0.01 THEN 'none' WHEN m * m / q >= c / vx * c / q THEN 'level' ELSE 'slope' END AS shape,
      round(bin_scatter, 6) AS bin_scatter, peak_bin, round(quietest_error, 6) AS quietest_error, round(busiest_error, 6) AS busiest_error, round(trend, 6) AS trend,
      round(mean_bias, 6) AS mean_bias, round(level_change_pct, 6) AS level_change_pct,
      CASE WHEN abs(trend) > 0.8 THEN 'attenuation' WHEN bin_scatter < 0.5 * abs(mean_bias) THEN 'level shift' ELSE 'concentrated' END AS profile_shape,
      (level_change_pct > 0) = (mean_bias > 0) AS level_explains_sign FROM l, r""",
)
def shape(spark, sf_dir):
    """The line through the errors, and beside it their profile over ten bins of the prediction and the change of the level."""
    test = _test(spark, sf_dir)
    profile = bias_by_bin(test, "pred_n", "n_events", "residual", 10)
    level = history_table(spark, sf_dir).agg(
        F.avg(F.when(F.col("split") == "test", F.col("n_events"))).alias("b"),
        F.avg(F.when(F.col("split") == "train", F.col("n_events"))).alias("a"),
    ).select(F.lit(100.0) * (F.try_divide(F.col("b"), F.col("a")) - 1))
    line = bias_shape(test, "residual", "pred_n")
    return rounded(line.crossJoin(profile_shape(profile, test.agg(F.avg("residual")).scalar(), level.scalar())))


@query(
    "horizon_decay",
    f"""WITH {NAIVE}, l AS (SELECT {LINE} FROM (SELECT residual AS y, date - DATE '1970-01-01' AS x FROM test))
    SELECT n, round(c / vx, 6) AS slope, round({SLOPE_SE}, 6) AS slope_se, round(m + c / vx * (x0 - mx), 6) AS at_start, round(m + c / vx * (x1 - mx), 6) AS at_end,
      abs(m + c / vx * (x1 - mx)) <= 0.5 * abs(m + c / vx * (x0 - mx)) AS fades FROM l""",
)
def decay(spark, sf_dir):
    return rounded(horizon_decay(_test(spark, sf_dir), "residual", F.col("date")))


CELLS = (
    NAIVE
    + """,
ctx AS (SELECT date, hour, sum(n_events) AS driver FROM hist GROUP BY 1, 2),
driven AS (SELECT n.*, c.driver FROM naive n JOIN ctx c ON c.date = n.date AND c.hour = n.hour),
cells AS (SELECT split, entity, hour, avg(driver) AS driver, sum(n_events)::DOUBLE / sum(driver) AS ratio, sum(driver)::DOUBLE / count(DISTINCT date) AS per_day FROM driven GROUP BY 1, 2, 3),
att AS (SELECT r.entity, r.hour, r.mean_error, b.driver - a.driver AS driver_change, CASE WHEN a.per_day >= 11 AND b.per_day >= 11 THEN b.ratio - a.ratio END AS conversion_change,
    a.per_day >= 11 AND b.per_day >= 11 AS supported
  FROM (SELECT entity, hour, avg(residual) AS mean_error FROM test GROUP BY 1, 2) r
  JOIN cells a ON a.split = 'train' AND a.entity = r.entity AND a.hour = r.hour JOIN cells b ON b.split = 'test' AND b.entity = r.entity AND b.hour = r.hour)"""
)


def _attribution(spark, sf_dir):
    rows = naive_table(spark, sf_dir)
    city = history_table(spark, sf_dir).groupBy("date", "hour").agg(F.sum("n_events").alias("driver"))
    driven = rows.join(city, on=["date", "hour"], how="left")

    def cells(split):
        return (
            driven.where(F.col("split") == split)
            .groupBy("entity", "hour")
            .agg(
                F.avg("driver").alias("driver"),
                F.try_divide(F.sum("n_events").cast("double"), F.sum("driver").cast("double")).alias("ratio"),
                (F.sum("driver") / F.count_distinct("date")).alias("per_day"),
            )
        )

    residuals = residual_report(rows.where(F.col("split") == "test"), "residual", ["entity", "hour"])
    return attribute_bias(
        residuals.select("entity", "hour", "mean_error"),
        cells("train"),
        cells("test"),
        ["entity", "hour"],
        "driver",
        "ratio",
        "per_day",
        11,
    )


@query(
    "attributed_bias",
    f"""WITH {CELLS} SELECT entity, hour, round(mean_error, 6) AS mean_error, round(driver_change, 6) AS driver_change, round(conversion_change, 6) AS conversion_change, supported FROM att""",
)
def attributed(spark, sf_dir):
    return rounded(_attribution(spark, sf_dir))


@query(
    "attribution_summary",
    f"""WITH {CELLS} SELECT round(corr(mean_error, driver_change), 6) AS driver_correlation, round(corr(mean_error, conversion_change), 6) AS conversion_correlation,
      count(*) FILTER (supported) AS supported_cells, count(*) FILTER (NOT supported) AS thin_cells FROM att""",
)
def attribution(spark, sf_dir):
    return rounded(attribution_summary(_attribution(spark, sf_dir)))


REVENUE = (
    NAIVE
    + """,
revenue AS (SELECT *, pred_n * pred_value AS pred_revenue, CASE WHEN n_lag_168h = 0 THEN 0.0::DOUBLE ELSE n_lag_168h * value_lag_168h END AS naive_revenue FROM test)"""
)


def _revenue(spark, sf_dir):
    return combine_revenue(_test(spark, sf_dir), "pred_n", "pred_value", "n_lag_168h", "value_lag_168h")


@query(
    "expected_revenue",
    f"""WITH {REVENUE} SELECT date, hour, entity, round(sum_value, 6) AS sum_value, round(pred_revenue, 6) AS pred_revenue, round(naive_revenue, 6) AS naive_revenue FROM revenue""",
)
def revenue(spark, sf_dir):
    return rounded(
        _revenue(spark, sf_dir).select(
            "date", "hour", "entity", "sum_value", "pred_revenue", "naive_revenue"
        )
    )


@query(
    "revenue_errors",
    f"""WITH {REVENUE}, r AS (SELECT 'naive' AS model, sum_value - naive_revenue AS e FROM revenue UNION ALL SELECT 'combined', sum_value - pred_revenue FROM revenue)
    SELECT 'revenue' AS target, model, count(e) AS n, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae FROM r GROUP BY model""",
)
def revenue_errors(spark, sf_dir):
    rows = [
        ("revenue", "naive", "sum_value", "naive_revenue", None),
        ("revenue", "combined", "sum_value", "pred_revenue", None),
    ]
    return rounded(comparison(_revenue(spark, sf_dir), rows))


@query(
    "revenue_surface",
    f"""WITH {REVENUE} SELECT entity, day_of_week, hour, round(avg(pred_revenue), 6) AS pred_revenue, round(avg(pred_value), 6) AS pred_value, round(avg(sum_value), 6) AS observed FROM revenue GROUP BY 1, 2, 3""",
)
def revenue_surface(spark, sf_dir):
    means = {"pred_revenue": "pred_revenue", "pred_value": "pred_value", "observed": "sum_value"}
    return rounded(surface(_revenue(spark, sf_dir), ["entity", "day_of_week", "hour"], means))


@query(
    "crossover",
    f"""WITH {REVENUE}, c AS (SELECT day_of_week, hour, avg(pred_revenue) FILTER (entity = 'click') AS click, avg(pred_revenue) FILTER (entity = 'view') AS view FROM revenue GROUP BY 1, 2)
    SELECT day_of_week, hour, round(click, 6) AS click, round(view, 6) AS view, round(view - click, 6) AS advantage FROM c WHERE view > click""",
)
def crossed(spark, sf_dir):
    cells = surface(
        _revenue(spark, sf_dir), ["entity", "day_of_week", "hour"], {"pred_revenue": "pred_revenue"}
    )
    return rounded(crossover(cells, ["day_of_week", "hour"], "entity", ("click", "view"), "pred_revenue"))


@query(
    "best_hours",
    f"""WITH {REVENUE}, c AS (SELECT entity, hour, round(avg(pred_revenue), 6) AS pred_revenue FROM revenue GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY pred_revenue DESC, hour) AS rank FROM c)
    SELECT entity, hour, pred_revenue, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def best(spark, sf_dir):
    cells = rounded(surface(_revenue(spark, sf_dir), ["entity", "hour"], {"pred_revenue": "pred_revenue"}))
    return best_hours(cells, "entity", "hour", "pred_revenue", 5)


@query(
    "peak_and_trough",
    f"""WITH {REVENUE}, c AS (SELECT entity, hour, round(avg(pred_n), 6) AS v FROM revenue GROUP BY 1, 2),
    h AS (SELECT entity, hour, v FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY v DESC, hour) AS k FROM c) WHERE k = 1),
    l AS (SELECT entity, hour, v FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY v, hour) AS k FROM c) WHERE k = 1)
    SELECT h.entity, h.hour AS peak_hour, h.v AS peak, l.hour AS trough_hour, l.v AS trough, round(h.v / greatest(l.v, 0.01), 6) AS peak_over_trough FROM h JOIN l ON l.entity = h.entity""",
)
def peaks(spark, sf_dir):
    cells = rounded(surface(_revenue(spark, sf_dir), ["entity", "hour"], {"pred_n": "pred_n"}))
    return rounded(peak_and_trough(cells, "entity", "hour", "pred_n"))
