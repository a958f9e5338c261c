import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.aggregate import group_share, ratio_of_sums, stack_keys
from tidegrid.operators.contracts import null_disagrees
from tidegrid.operators.gaps import carry_forward, collapse_duplicates, resolve_with_source
from tidegrid.operators.grid import check_grid, densify, hour_grid
from tidegrid.operators.history import add_lags, add_neighbours, add_trailing_means
from tidegrid.operators.joins import checked_left_join, join_audit, peer_mean, verify_lag
from tidegrid.operators.rules import apply_rules, min_support, rule_waterfall


@pytest.fixture(scope="module")
def grid(spark):
    sites = spark.createDataFrame([("A",), ("B",)], "entity string")
    rows = hour_grid(spark, "2023-01-01", "2024-07-01", sites)
    return rows.select("*", (F.hash("date", "hour", "entity") % 50).alias("n"))


def test_grid_size_and_history_nulls(grid):
    assert grid.count() == 547 * 24 * 2
    lagged = add_lags(grid, [("n", 168, "lag")], ["entity"])
    assert lagged.where(F.col("lag").isNull()).count() == 7 * 24 * 2
    both = add_neighbours(grid, "n", ["entity"])
    edge = F.col("n_prev_hr").isNull() | F.col("n_next_hr").isNull()
    assert both.where(edge).count() == 4


def test_verified_lag_catches_a_wrong_lag(grid):
    right = add_lags(grid, [("n", 168, "lag")], ["entity"])
    wrong = add_lags(grid, [("n", 167, "lag")], ["entity"])
    assert verify_lag(right, "n", "lag", 7, ["entity"]).head()["mismatches"] == 0
    assert verify_lag(wrong, "n", "lag", 7, ["entity"]).head()["mismatches"] > 0


def test_verified_lag_counts_null_mismatches(grid):
    broken = add_lags(grid, [("n", 168, "lag")], ["entity"]).select(
        "date", "hour", "entity", "n", F.when(F.col("hour") != 3, F.col("lag")).alias("lag")
    )
    assert verify_lag(broken, "n", "lag", 7, ["entity"]).head()["mismatches"] == 540 * 2


def test_trailing_mean_never_sees_the_current_row(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(d), 5, "A", 1.0 if d < 7 else 100.0) for d in range(8)]
    df = spark.createDataFrame(rows, "date date, hour int, entity string, v double")
    out = add_trailing_means(df, {"v": "m"}, 7, ["entity"]).orderBy("date").collect()
    assert out[0]["m"] is None and out[7]["m"] == 1.0


def test_carry_forward_is_bounded(spark):
    rows = [("A", i, v) for i, v in enumerate([1.0, None, None, None, None])]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    out = carry_forward(df, {"v": 3}, ["s"], ["i"]).orderBy("i").collect()
    assert [r["v"] for r in out] == [1.0, 1.0, 1.0, 1.0, None]
    assert [r["v_imputed"] for r in out] == [False, True, True, True, False]
    assert [r["v_missing"] for r in out] == [False] * 4 + [True]


def test_fallback_order_and_labels(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 9.0, False), (2, 2.0, 9.0, True), (3, None, 9.0, False), (4, None, None, False)],
        "i int, v double, p double, v_imputed boolean",
    )
    out = resolve_with_source(df, "v", "p", 0.0, carried="v_imputed").orderBy("i").collect()
    assert [(r["v"], r["v_source"]) for r in out] == [
        (1.0, "observed"),
        (2.0, "carried"),
        (9.0, "peers"),
        (0.0, "assumed"),
    ]


def test_missing_is_not_zero(spark):
    sites = spark.createDataFrame([("A",)], "entity string")
    cells = hour_grid(spark, "2024-01-01", "2024-01-02", sites)
    agg = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 4, "A", 2, 10.0, 5.0)],
        "date date, hour int, entity string, n long, s double, m double",
    )
    full = densify(agg, cells, ["date", "hour", "entity"], ["n", "s"])
    empty = full.where("hour = 5").head()
    assert (empty["n"], empty["s"], empty["m"]) == (0, 0.0, None)
    checks = check_grid(full, ["date", "hour", "entity"], 24, {"den": null_disagrees("m", "n")})
    assert {r["violations"] for r in checks.collect()} == {0}
    doubled = full.unionByName(full.where("hour = 4"))
    found = {r["check_name"]: r["violations"] for r in check_grid(doubled, ["date", "hour", "entity"], 24).collect()}
    assert found == {"grid_rows": 1, "duplicate_keys": 1}


def test_waterfall_counts_a_null_as_excluded(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 5.0), (2, 1.0), (1, 1.0)], "code int, fare double")
    rules = [
        ("known", F.col("code").isNull() | F.col("code").isin(1, 2)),
        ("minimum", ~F.col("code").eqNullSafe(1) | (F.col("fare") >= 3)),
        ("bare", F.col("code") > 0),
    ]
    steps = rule_waterfall(df, rules).orderBy("step_no").collect()
    assert [(r["row_count"], r["removed"]) for r in steps] == [(4, None), (4, 0), (3, 1), (2, 1)]
    assert apply_rules(df, rules).count() == steps[-1]["row_count"]
    assert [r["pct_of_raw"] for r in steps] == [100.0, 100.0, 75.0, 50.0]


def test_min_support_nulls_or_drops(spark):
    df = spark.createDataFrame([(1, 7.0), (5, 8.0)], "n int, v double")
    assert min_support(df, "n", 3, drop=True).count() == 1
    assert [r["v"] for r in min_support(df, "n", 3, ["v"]).orderBy("n").collect()] == [None, 8.0]


def test_checked_join_rejects_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert checked_left_join(left, good, ["k"]).count() == 3
    with pytest.raises(ValueError, match="repeats keys"):
        checked_left_join(left, good.unionByName(good.where("k = 2")), ["k"], "dims")
    audit = join_audit(left, good.unionByName(good.where("k = 2")), ["k"], "x").head()
    assert (audit["left_rows"], audit["duplicate_right_keys"], audit["joined_rows"]) == (3, 1, 5)


def test_peer_mean_joins_back_without_new_rows(spark):
    df = spark.createDataFrame([("A", 1, 2.0), ("B", 1, None), ("C", 1, 6.0), ("A", 2, None)], "e string, h int, v double")
    out = {(r["e"], r["h"]): r["p"] for r in peer_mean(df, ["h"], "v", F.col("e").isin("A", "C"), "p").collect()}
    assert out == {("A", 1): 4.0, ("B", 1): 4.0, ("C", 1): 4.0, ("A", 2): None}


def test_collapse_duplicates_averages_once(spark):
    df = spark.createDataFrame([("A", 1, 2.0, 10), ("A", 1, 4.0, 9), ("A", 2, 1.0, 11)], "s string, h int, v double, at int")
    out = {r["h"]: (r["v"], r["at"], r["merged_rows"]) for r in collapse_duplicates(df, ["s", "h"], ["v"], ["at"]).collect()}
    assert out == {1: (3.0, 9, 2), 2: (1.0, 11, 1)}


def test_ratio_is_of_sums(spark):
    df = spark.createDataFrame([("A", 1, 1), ("A", 99, 1), ("B", 3, 0)], "g string, n int, d int")
    out = {r["g"]: r["ratio"] for r in ratio_of_sums(df, "n", "d", ["g"]).collect()}
    assert out == {"A": 50.0, "B": None}


def test_shares_add_up_within_a_hot_group(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("z"), F.when(F.col("id") < 2000, "hot").otherwise("b").alias("g"), F.lit(1).alias("n"))
    out = group_share(df, "n", ["g", "z"], ["g"]).groupBy("g").agg(F.sum("share_pct").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 1e-9 for r in out)


def test_stacked_keys_keep_each_kind_apart(spark):
    df = spark.createDataFrame([(1, 2, True), (3, None, False)], "a int, b int, ok boolean")
    out = stack_keys(
        df,
        {"x": ({"k": F.col("a")}, F.lit(True)), "y": ({"k": F.col("b")}, F.col("ok"))},
        ["ok"],
    )
    assert {(r["kind"], r["k"]) for r in out.collect()} == {("x", 1), ("x", 3), ("y", 2)}
