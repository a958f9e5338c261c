import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.operators.order_stats import average_rank, bracketed_counts, exact_quantiles, value_counts
from tidegrid.operators.profile import (
    dispersion_summary,
    distribution_flags,
    distribution_summary,
    quantile_bins,
    spearman,
    tukey_fences,
)

PROBS = [0.01, 0.25, 0.5, 0.75, 0.95, 0.999]


def disc(values, p):
    ordered = sorted(values)
    n = len(ordered)
    return ordered[max(math.ceil(round(n * p, 9)), 1) - 1]


def make(spark, groups):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(7)
    return {
        "skewed": np.round(rng.lognormal(3, 2, 3000), 2),
        "signed": np.round(rng.normal(0, 5, 1001), 3),
        "hot": np.concatenate([np.full(900, 42.0), rng.normal(42, 1e-6, 300)]),
        "narrow": 1.7e9 + rng.uniform(0, 1e4, 2000),
        "single": np.array([-3.5]),
        "zeros": np.zeros(10),
    }


@pytest.mark.parametrize("fixed", [True, False])
def test_quantiles_match_brute_force(spark, groups, fixed):
    counts = value_counts(make(spark, groups), {"v": F.col("v")}, by=["g"])
    got = exact_quantiles(counts, ["g", "metric"], PROBS, fixed_groups=fixed).collect()
    assert len(got) == len(groups) * len(PROBS)
    for row in got:
        assert row["quantile"] == disc(groups[row["g"]], row["prob"]), row


def test_interpolated_quantiles_match_numpy(spark, groups):
    counts = value_counts(make(spark, groups), {"v": F.col("v")}, by=["g"])
    for row in exact_quantiles(counts, ["g", "metric"], PROBS, interpolate=True).collect():
        want = np.quantile(groups[row["g"]], row["prob"])
        assert row["quantile"] == pytest.approx(want, rel=1e-12, abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_any_median(spark, values):
    counts = value_counts(make(spark, {"a": values}), {"v": F.col("v")})
    row = exact_quantiles(counts, ["metric"], [0.5]).head()
    assert row["quantile"] == disc(values, 0.5)


def test_nulls_and_nan_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert value_counts(df, {"v": F.col("v")}).agg(F.sum("n")).head()[0] == 2


def test_average_ranks_match_pandas(spark, groups):
    counts = value_counts(make(spark, groups), {"v": F.col("v")}, by=["g"])
    got = average_rank(counts, ["g", "metric"]).toPandas()
    for name, values in groups.items():
        want = pd.Series(values).rank(pct=True).groupby(pd.Series(values)).first()
        mine = got[got["g"] == name].set_index("value")["pct_rank"].sort_index()
        assert np.allclose(mine.to_numpy(), want.to_numpy())


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": "a", "x": rng.integers(0, 9, 200) * 1.0, "y": rng.normal(size=200)})
    row = spearman(spark.createDataFrame(frame), "x", "y", ["g"]).head()
    assert row["spearman"] == pytest.approx(frame["x"].rank().corr(frame["y"].rank()))


def test_bins_match_qcut(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.exponential(3, 500), 1)
    frame = pd.DataFrame({"i": range(500), "v": values})
    got = quantile_bins(spark.createDataFrame(frame), "v", 10).toPandas().set_index("i")["bin"]
    want = pd.qcut(frame["v"], 10, labels=False, duplicates="drop") + 1
    assert (got.sort_index().to_numpy() == want.to_numpy()).all()


def test_distribution_and_fences_by_segment(spark):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame({"s": rng.integers(0, 2, 400), "v": rng.lognormal(1, 1, 400)})
    df = spark.createDataFrame(frame)
    segments = {"all": F.lit(True), "one": F.col("s") == 1}
    summary = {r["segment"]: r for r in distribution_summary(df, segments, {"v": F.col("v")}).collect()}
    one = frame[frame["s"] == 1]["v"]
    assert summary["one"]["n"] == len(one)
    assert summary["one"]["p95"] == disc(one, 0.95)
    assert summary["all"]["sd"] == pytest.approx(frame["v"].std())
    fences = {r["segment"]: r for r in tukey_fences(df, segments, {"v": F.col("v")}).collect()}
    fence = disc(one, 0.75) + 1.5 * (disc(one, 0.75) - disc(one, 0.25))
    assert fences["one"]["upper_fence"] == pytest.approx(fence)
    assert fences["one"]["n_above_fence"] == (one > fence).sum()


def test_a_dominating_record_is_flagged(spark):
    df = spark.createDataFrame([(1.0,)] * 50 + [(1e6,)], "v double")
    summary = distribution_summary(df, {"all": F.lit(True)}, {"v": F.col("v")})
    row = distribution_flags(summary).head()
    assert row["variance_dominated"] and row["tail_unresolved"]


def test_dispersion_median(spark):
    cells = spark.createDataFrame([("A", 1.0), ("A", 2.0), ("A", 4.0), ("A", None)], "e string, dispersion double")
    row = dispersion_summary(cells, ["e"]).head()
    assert (row["median_dispersion"], row["overdispersed_cells"], row["cells"]) == (2.0, 2, 4)


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_bracketed_quantiles_are_exact_and_few_values_are_ordered(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    n = 60_000
    values = rng.lognormal(size=n)
    values[: n // 3] = 1.25  # a hot value
    frame = pd.DataFrame({"v": values, "w": -rng.permutation(n) * 1.0, "s": rng.random(n) < 0.1})
    df = spark.createDataFrame(frame).repartition(7).cache()
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999, 1.0]
    metrics = {"v": F.col("v"), "w": F.col("w")}
    segments = {"all": F.lit(True), "some": F.col("s"), "none": F.lit(None).cast("boolean")}
    counts = bracketed_counts(df, metrics, probs, segments, accuracy).cache()
    if accuracy == 100:
        # of the 60,000 values of w, those inside 8 + 8 brackets of 8 errors at most
        assert counts.where("metric = 'w' AND segment = 'all'").count() < 0.75 * n
        one = bracketed_counts(df, {"w": F.col("w")}, [0.5], accuracy=1000)
        assert one.count() < 0.02 * n and one.agg(F.sum("n")).head()[0] == n
    for interpolate in (False, True):
        got = {(r["segment"], r["metric"], r["prob"]): r["quantile"] for r in exact_quantiles(counts, ["segment", "metric"], probs, interpolate, True).collect()}
        assert len(got) == 2 * 2 * len(probs)
        for segment, rows in (("all", frame), ("some", frame[frame.s])):
            for m in "vw":
                told = np.quantile(rows[m], probs, method="linear" if interpolate else "inverted_cdf")
                assert [got[segment, m, p] for p in probs] == pytest.approx(list(told), rel=1e-12)


def test_bracketed_counts_of_odd_columns(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (3.0,), (float("inf"),), (-0.0,)], "v double")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(bracketed_counts(df, {"v": F.col("v")}, [0.0, 0.5, 1.0]), ["metric"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.5: 3.0, 1.0: float("inf")}
    assert bracketed_counts(df.limit(0), {"v": F.col("v")}, [0.5]).count() == 0
