"""Checked joins, audits, dimension roll-ups, peer means and verified lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.operators.history import add_lags
from tidegrid.operators.joins import (
    checked_left_join,
    duplicate_keys,
    fanout_join,
    join_audit,
    join_dim,
    peer_mean,
    period_compare,
    rollup_to_dim,
    spread_context,
    verify_lag,
)
from tidegrid.plans import study
from tidegrid.plans.entity_hours import entity_hours
from tidegrid.sources.staging import stage


def _orders(spark, sf_dir):
    return study.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderpriority"
    )


@query(
    "checked_join",
    """SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""",
)
def checked_join(spark, sf_dir):
    customers = study.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = checked_left_join(_orders(spark, sf_dir), customers, ["c_custkey"], "customers")
    return rounded(
        joined.groupBy("c_mktsegment").agg(
            F.count("*").alias("orders"), F.sum("o_totalprice").alias("revenue")
        ),
        2,
    )


@query(
    "join_audit",
    """WITH a AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem),
    d AS (SELECT k, n, count(*) AS c FROM a GROUP BY k, n)
    SELECT 'customers' AS label, (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM customer) AS right_rows,
      CAST(0 AS BIGINT) AS duplicate_right_keys,
      (SELECT count(*) FROM orders LEFT JOIN customer ON c_custkey = o_custkey) AS joined_rows,
      (SELECT count(*) FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE c_custkey IS NULL) AS unmatched_left_rows
    UNION ALL
    SELECT 'lines', (SELECT count(*) FROM a), (SELECT count(*) FROM a), (SELECT count(*) FROM d WHERE c > 1),
      (SELECT CAST(sum(c * c) AS BIGINT) FROM d), CAST(0 AS BIGINT)""",
)
def audits(spark, sf_dir):
    customers = study.table(spark, sf_dir, "customer").select("c_custkey")
    lines = study.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    good = join_audit(_orders(spark, sf_dir), customers, ["c_custkey"], "customers")
    return good.unionByName(join_audit(lines, lines, ["l_orderkey", "l_linenumber"], "lines"))


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, sf_dir):
    return duplicate_keys(study.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fanout_join",
    f"""WITH {HOURS}, ctx AS (SELECT date, hour, sum(n_events) AS city_events, round(sum(sum_value), 6) AS city_value FROM hours GROUP BY date, hour)
    SELECT h.date, h.hour, h.entity, h.n_events, CAST(city_events AS BIGINT) AS city_events, city_value
    FROM hours h LEFT JOIN ctx ON ctx.date = h.date AND ctx.hour = h.hour""",
)
def fanout(spark, sf_dir):
    hours = stage(entity_hours(spark, sf_dir))
    city = hours.groupBy("date", "hour").agg(
        F.sum("n_events").alias("city_events"), F.sum("sum_value").alias("city_value")
    )
    return rounded(
        fanout_join(hours.select(*study.KEY, "n_events"), city, ["date", "hour"], "context")
    )


@query(
    "dim_rollup",
    """SELECT r_name, n_name, count(*) AS row_count, round(sum(o_totalprice), 2) AS o_totalprice
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY r_name, n_name""",
)
def dim_rollup(spark, sf_dir):
    customers = study.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = study.table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")
    )
    regions = study.table(spark, sf_dir, "region")
    path = [(customers, "c_custkey"), (nations, "n_nationkey"), (regions, "r_regionkey")]
    return rounded(
        rollup_to_dim(_orders(spark, sf_dir), "c_custkey", ["o_totalprice"], path, ["r_name", "n_name"]),
        2,
    )


@query(
    "dim_join",
    """SELECT c_custkey, c_acctbal, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def dim_join(spark, sf_dir):
    customers = study.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = study.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return join_dim(customers, nations, ["n_nationkey"]).drop("n_nationkey")


@query(
    "peer_mean",
    f"""WITH {HOURS}, p AS (SELECT date, hour, avg(mean_value) AS m, count(mean_value) AS c FROM hours
      WHERE entity IN ('click', 'view', 'signup') GROUP BY date, hour)
    SELECT h.date, h.hour, h.entity, round(h.mean_value, 6) AS mean_value, round(p.m, 6) AS peers, coalesce(p.c, 0) AS peers_reporting
    FROM hours h LEFT JOIN p ON p.date = h.date AND p.hour = h.hour""",
)
def peers(spark, sf_dir):
    hours = entity_hours(spark, sf_dir).select(*study.KEY, "mean_value")
    some = F.col("entity").isin("click", "view", "signup")
    return rounded(peer_mean(hours, ["date", "hour"], "mean_value", some, "peers"))


@query(
    "spread_context",
    f"""WITH {HOURS} SELECT h.date, h.hour, h.entity, c.n_events AS ctx_n_events, round(c.mean_value, 6) AS ctx_mean_value
    FROM hours h LEFT JOIN hours c ON c.date = h.date AND c.hour = h.hour AND c.entity = 'error'""",
)
def spread(spark, sf_dir):
    out = spread_context(
        entity_hours(spark, sf_dir),
        ["date", "hour"],
        F.col("entity") == "error",
        ["n_events", "mean_value"],
        "ctx_",
    )
    return rounded(out.select(*study.KEY, "ctx_n_events", "ctx_mean_value"))


@query(
    "lag_verified",
    f"""WITH {HOURS}, l AS (SELECT *, lag(mean_value, 168) OVER (PARTITION BY entity ORDER BY date, hour) AS lagged FROM hours)
    SELECT count(*) AS rows_checked, count(*) FILTER (t.date IS NOT NULL) AS rows_with_history,
      count(*) FILTER (l.lagged IS DISTINCT FROM t.mean_value) AS mismatches
    FROM l LEFT JOIN hours t ON t.entity = l.entity AND t.hour = l.hour AND t.date = l.date - 7""",
)
def lag_verified(spark, sf_dir):
    hours = add_lags(
        entity_hours(spark, sf_dir), [("mean_value", 168, "mean_value_lag_168h")], ["entity"]
    )
    return verify_lag(hours, "mean_value", "mean_value_lag_168h", 7, ["entity"])


@query(
    "period_cells",
    f"""WITH {HOURS}, c AS (SELECT entity, hour, avg(n_events) FILTER (date < DATE '2024-01-22') AS a,
      avg(n_events) FILTER (date >= DATE '2024-01-22') AS b,
      sum(n_events) FILTER (date < DATE '2024-01-22') AS na, sum(n_events) FILTER (date >= DATE '2024-01-22') AS nb
      FROM hours GROUP BY entity, hour)
    SELECT entity, hour, round(a, 6) AS train_mean_events, CAST(na AS BIGINT) AS train_total, round(b, 6) AS test_mean_events,
      CAST(nb AS BIGINT) AS test_total, round(b - a, 6) AS change, coalesce(na >= 30 AND nb >= 30, false) AS supported FROM c""",
)
def period_cells(spark, sf_dir):
    hours = stage(entity_hours(spark, sf_dir))
    cut = F.lit(study.CUT).cast("date")

    def cells(df):
        return df.groupBy("entity", "hour").agg(
            F.avg("n_events").alias("mean_events"), F.sum("n_events").alias("total")
        )

    return rounded(
        period_compare(
            cells(hours.where(F.col("date") < cut)),
            cells(hours.where(F.col("date") >= cut)),
            ["entity", "hour"],
            "mean_events",
            ("train", "test"),
            "total",
            30,
        )
    )
