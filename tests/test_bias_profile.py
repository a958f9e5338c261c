"""The profile of a bias over bins of the prediction, beside its line."""

import pytest
from pyspark.sql import functions as F

from tidegrid.catalog import ORACLES, QUERIES
from tidegrid.operators.evaluate import bias_by_bin, profile_shape


@pytest.mark.parametrize(
    "error, shape, peak",
    [
        (lambda i: (i - 50) / 10.0, "attenuation", 1),
        (lambda i: 5.0 + (0.1 if i % 20 < 10 else -0.1), "level shift", 1),
        (lambda i: 8.0 if 30 <= i < 40 else (0.3 if i % 20 < 10 else -0.3), "concentrated", 4),
    ],
)
def test_shape_of_a_profile(spark, error, shape, peak):
    df = spark.createDataFrame([(float(i), float(i) + error(i), error(i)) for i in range(100)], "p double, y double, r double")
    profile = bias_by_bin(df, "p", "y", "r", 10)
    row = profile_shape(profile, df.agg(F.avg("r")).scalar(), F.lit(1.0)).head()
    mean = sum(map(error, range(100))) / 100
    assert row["profile_shape"] == shape and row["mean_bias"] == pytest.approx(mean) and row["level_change_pct"] == 1.0
    assert row["level_explains_sign"] == (mean > 0)
    if shape != "level shift":
        assert row["peak_bin"] == peak
    assert profile_shape(profile, F.lit(0.0), F.lit(1.0), monotone_above=2.0, even_below=0.0).head()["profile_shape"] == "concentrated"


def test_tied_errors_share_their_rank(spark):
    profile = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 2.0), (3, 3.0, 5.0)], "bin int, mean_predicted double, mean_error double")
    row = profile_shape(profile, F.lit(3.0), F.lit(-1.0)).head()
    assert row["trend"] == pytest.approx(0.8660254037844387) and row["profile_shape"] == "attenuation"
    assert (row["quietest_error"], row["busiest_error"], row["peak_bin"], row["level_explains_sign"]) == (2.0, 5.0, 3, False)


def test_the_query_tells_line_and_profile(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    duckdb.sql(
        f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds((i * 7919 % 2592000)::INT) AS ts, i % 50 AS user_id,
          ['click', 'error', 'purchase', 'signup', 'view'][1 + (hash(i) % 5)::INT] AS event_type, (hash(i, 1) % 10000 / 100.0)::DOUBLE AS value, '{{"k": ' || hash(i, 2) % 100 || '}}' AS props
        FROM range(30000) t(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)"""
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    told = con.execute(ORACLES["bias_shape"])
    want = dict(zip([d[0] for d in told.description], told.fetchone(), strict=True))
    got = QUERIES["bias_shape"](spark, str(tmp_path)).head().asDict()
    assert {"shape", "slope", "bin_scatter", "peak_bin", "quietest_error", "busiest_error", "trend", "mean_bias", "level_change_pct", "profile_shape", "level_explains_sign"} <= set(got)
    assert got == want
