import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.operators.evaluate import (
    autocorrelation,
    bias_shape,
    horizon_decay,
    combine_revenue,
    error_metrics,
    poisson_deviance,
    residual_covariance,
    score_common,
    winner_per_loss,
)


def test_deviance_handles_zero_counts(spark):
    rows = [(0.0, 0.4, 76.25), (0.0, 12.0, 76.25), (5.0, 4.0, 76.25), (300.0, 280.0, 76.25)]
    df = spark.createDataFrame(rows, "y double, mu double, flat double")
    row = poisson_deviance(df, "y", {"fitted": "mu", "flat": "flat"}).head()
    assert row["fitted"] == pytest.approx(6.606789601328238, abs=1e-12)
    assert row["flat"] == pytest.approx(198.6533, abs=1e-4)


def test_covariance_leaves_the_empty_hour_out(spark):
    rows = [
        (10.0, 8.0, 50.0, 49.0, 500.0),
        (20.0, 18.0, 60.0, 58.0, 1200.0),
        (30.0, 26.0, 70.0, 66.0, 2100.0),
        (0.0, 0.5, None, 55.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "n double, nh double, v double, vh double, r double")
    row = residual_covariance(df, ("n", "nh"), ("v", "vh"), "r").head()
    assert row["covariance"] == pytest.approx(22 / 3, abs=1e-12)
    assert row["shortfall_per_hour"] == pytest.approx(155.125)
    assert row["n_defined"] == 3


@pytest.mark.parametrize("deviance, agree", [((9.0, 7.0), False), ((7.0, 9.0), True)])
def test_winner_per_loss(spark, deviance, agree):
    df = spark.createDataFrame(
        [("poisson", 40.644, deviance[0]), ("negative binomial", 44.086, deviance[1])],
        "model string, rmse double, deviance double",
    )
    row = winner_per_loss(df, "model", ["rmse", "deviance"]).head()
    assert row["rmse_winner"] == "poisson" and row["losses_agree"] is agree


def test_an_empty_week_ago_is_zero_revenue(spark):
    df = spark.createDataFrame([(2.0, 3.0, 0, None), (2.0, 3.0, 4, 5.0)], "n double, v double, ln int, lv double")
    rows = combine_revenue(df, "n", "v", "ln", "lv").collect()
    assert [r["naive_revenue"] for r in rows] == [0.0, 20.0]
    assert rows[0]["pred_revenue"] == 6.0


def test_metrics_skip_rows_missing_a_side(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, None), (5.0, 2.0)], "y double, p double")
    row = error_metrics(df, "y", "p").head()
    assert (row["n"], row["mae"]) == (2, 2.0) and row["rmse"] == pytest.approx(5**0.5)


def test_error_on_dropped_rows_comes_from_sums_of_squares(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.5), (4.0, 2.0, 3.0), (9.0, 5.0, None)], "y double, p double, b double")
    row = score_common(df, "y", "p", "b").head()
    assert (row["n_common"], row["n_full"], row["n_dropped"]) == (2, 3, 1)
    assert row["dropped_rmse"] == pytest.approx(4.0)


@pytest.mark.parametrize(
    "error, shape",
    [
        (lambda i: (i - 49.5) / 10.0 + 0.2, "slope"),
        (lambda i: 5.0 + (0.1 if i % 20 < 10 else -0.1), "level"),
        (lambda i: 1.0 if i % 2 else -1.0, "none"),
    ],
)
def test_bias_shapes(spark, error, shape):
    rows = [(float(i), float(i) + error(i), error(i)) for i in range(100)]
    df = spark.createDataFrame([*rows, (None, 1.0, 9.0)], "p double, y double, r double")
    row = bias_shape(df, "r", "p").head()
    p, r = np.array([x[0] for x in rows]), np.array([x[2] for x in rows])
    slope, level = np.polyfit(p, r, 1)
    left = r - slope * p - level
    assert row["shape"] == shape and row["n"] == 100 and row["slope"] == pytest.approx(slope, abs=1e-9)
    assert row["slope_se"] == pytest.approx(math.sqrt(left @ left / 98 / ((p - p.mean()) ** 2).sum()), rel=1e-6, abs=1e-9)
    assert row["level_share"] + row["slope_share"] == pytest.approx(1 - left @ left / (r @ r), abs=1e-9)


def test_a_bias_that_fades_and_one_that_does_not(spark):
    rows = [(f"2024-01-{d:02d}", 10.0 - d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "d string, r double").withColumn("d", F.col("d").cast("date"))
    row = horizon_decay(df, "r", F.col("d")).head()
    assert (row["at_start"], row["at_end"], row["slope"]) == (pytest.approx(9), pytest.approx(0, abs=1e-9), pytest.approx(-1)) and row["fades"]
    assert not horizon_decay(df, "r", F.col("d"), fades_to=-1.0).head()["fades"]
    assert horizon_decay(df.withColumn("r", F.lit(4.0)), "r", F.col("d")).head()["fades"] is False


def test_autocorrelation_does_not_bridge_a_removed_hour(spark):
    import datetime as dt

    rows = [("A", dt.date(2024, 1, 1), h, float(h % 5), h != 7) for h in range(24)]
    df = spark.createDataFrame(rows, "entity string, date date, hour int, r double, keep boolean")
    row = autocorrelation(df, F.col("r"), ["entity"], keep=F.col("keep")).head()
    assert row["pairs"] == 21
