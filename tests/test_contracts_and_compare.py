import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.compare import (
    event_day_compare,
    lag_correlation,
    matched_cells,
    matched_compare,
    peak_lag,
    t_p_value,
)
from tidegrid.operators.contracts import (
    collect_features,
    conserved,
    leaks,
    null_audit,
    require_empty,
    role_problems,
    roles_table,
)
from tidegrid.operators.reshape import arg_extreme, top_per_group, weekday_hour_matrix
from tidegrid.plans import model_table as plan


def test_every_column_has_one_role(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    roles = roles_table(spark, {"key": ["a"], "flag": ["b"], "target": ["b", "d"]}, {"g": ["a"]})
    found = {(r["column_name"], r["problem"]) for r in role_problems(df, roles).collect()}
    assert found == {("c", "undeclared"), ("d", "absent"), ("b", "two roles")}


def test_model_table_roles_and_leaks(spark):
    table = plan.model_table(spark, "/root/testdata/sf0.001")
    roles = roles_table(spark, plan.ROLES, plan.FEATURES)
    require_empty(role_problems(table, roles), "roles")
    require_empty(leaks(roles), "leaks")
    planted = roles_table(spark, plan.ROLES, {**plan.FEATURES, "x": ["mean_delay"]})
    with pytest.raises(ValueError, match="mean_delay"):
        require_empty(leaks(planted), "leaks")


def test_features_keep_first_occurrence(spark):
    roles = roles_table(spark, {}, {"a": ["x", "y"], "b": ["y", "z"], "c": ["w"]})
    rows = collect_features(roles, ["b", "a"]).orderBy("group_position", "position").collect()
    assert [r["column_name"] for r in rows] == ["y", "z", "x"]


def test_undocumented_nulls_are_unexplained(spark):
    df = spark.createDataFrame([(None, 1, None), (1, None, 2)], "a_lag_1h int, b int, c int")
    audit = null_audit(df, {"documented": ["b"]}, {"history": ["_lag_1h"]})
    assert {r["column_name"]: r["family"] for r in audit.collect()} == {
        "a_lag_1h": "history",
        "b": "documented",
        "c": "UNEXPLAINED",
    }


def test_totals_are_compared_with_a_tolerance(spark):
    a = spark.createDataFrame([(0.1,)] * 10, "v double")
    b = spark.createDataFrame([(1.0,)], "v double")
    pair = {"v": (F.sum("v"), F.sum("v"))}
    assert conserved(a, b, pair, 1e-6).head()["holds"]
    assert not conserved(a, b.limit(0), pair, 1e-6).head()["holds"]


@pytest.mark.parametrize(
    "t, dof, p",
    [
        (12.7062, 1, 0.05),
        (4.3027, 2, 0.05),
        (3.1824, 3, 0.05),
        (2.2281, 10, 0.05),
        (-2.0687, 23, 0.05),
        (2.8073, 23, 0.01),
        (0.0, 7, 1.0),
        (1.9623, 1000, 0.05),
    ],
)
def test_t_probabilities_match_the_tables(spark, t, dof, p):
    df = spark.createDataFrame([(t, dof)], "t double, n int")
    assert df.select(t_p_value(F.col("t"), F.col("n"))).head()[0] == pytest.approx(p, abs=2e-5)


def test_matched_change_is_weighted_by_exposure(spark):
    rows = [("A", 1, True, 12.0)] * 3 + [("A", 1, False, 10.0)] + [("A", 2, True, 1.0), ("A", 2, False, 0.1)]
    rows += [("A", 3, True, 50.0)]
    df = spark.createDataFrame(rows, "e string, h int, wet boolean, v double")
    cells = matched_cells(df, F.col("wet"), ["e", "h"], {"v": "v"})
    assert cells.count() == 2
    row = matched_compare(cells, ["e"], ["v"]).head()
    assert row["v_delta"] == pytest.approx((3 * 2.0 + 0.9) / 4)
    assert row["v_pct"] == pytest.approx(100 * (3 * 2.0 + 0.9) / (3 * 10.0 + 0.1))


def test_peak_lag_is_found(spark):
    pulse = [0, 1, 5, 2, 0, 3, 8, 1, 0, 4, 6, 2]
    rows = [("A", dt.date(2024, 1, 1), h, pulse[h], pulse[h - 1] if h else 0) for h in range(12)]
    df = spark.createDataFrame(rows, "entity string, date date, hour int, x int, y int")
    table = lag_correlation(df, "y", "x", [-1, 0, 1], ["entity"])
    assert peak_lag(table, ["entity"]).head()["peak_lag"] == 1


def test_event_day_against_both_norms(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(d), 10 if d != 14 else 4, 10.0, 9.0 if d == 14 else 0.0) for d in range(29)]
    df = spark.createDataFrame(rows, "date date, n int, norm double, rain double").select(
        "*", (F.weekday("date") + 1).alias("day_of_week")
    )
    row = event_day_compare(df, "rain", "n", "norm").head()
    assert row["event_date"] == dt.date(2024, 1, 15)
    assert (row["observed"], row["seasonal_days"]) == (4.0, 4)
    assert row["vs_seasonal_pct"] == pytest.approx(-60.0) and row["vs_trailing_pct"] == pytest.approx(-60.0)


def test_matrix_keeps_missing_cells_null(spark):
    df = spark.createDataFrame([("A", 2, 5, 4.0)], "e string, day_of_week int, hour int, v double")
    rows = weekday_hour_matrix(df, "v", ["e"]).orderBy("day_of_week").collect()
    assert len(rows) == 7 and rows[1]["h05"] == 4.0 and rows[0]["h05"] is None


def test_ties_are_broken_by_the_caller(spark):
    df = spark.createDataFrame([("A", 3, 5), ("A", 1, 5), ("A", 2, 9)], "e string, h int, v int")
    top = top_per_group(df, ["e"], [F.desc("v"), F.col("h")], 2).orderBy("rank").collect()
    assert [r["h"] for r in top] == [2, 1]
    assert arg_extreme(df, ["e"], "v", ["h"], largest=False).head()["h"] == 1
