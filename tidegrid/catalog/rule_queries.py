"""Ordered rules, flags, profiles of missing metadata and minimum support."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.functions.columns import (
    flag_equals,
    flag_missing,
    guarded_rate,
    in_wrapped_range,
    label_case,
)
from tidegrid.operators.aggregate import missing_profile, share_where
from tidegrid.operators.rules import apply_rules, min_support, rule_waterfall
from tidegrid.plans import shipments, study
from tidegrid.plans.entity_hours import entity_hours

SHIPMENTS = """
shipments AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority, o.o_custkey,
         date_diff('day', o.o_orderdate, l.l_shipdate) AS delay_days,
         CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END AS unit_price,
         l_extendedprice * (1 - l_discount) AS net_value,
         NULLIF(l_linenumber, 7) AS line_code, NULLIF(l_linestatus, 'F') AS status
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)"""

RULES = (
    ("discount within policy", "l_discount <= 0.08::DOUBLE"),
    ("tax within policy", "l_tax <= 0.07::DOUBLE"),
    ("not returned while open", "NOT (l_returnflag = 'R' AND l_linestatus = 'O')"),
    ("unit price worth a line", "unit_price >= 100"),
    ("net value worth a shipment", "net_value >= 2000"),
    ("not shipped before the order", "delay_days >= 0"),
    ("shipped within two years", "delay_days <= 730"),
    ("urgent orders within one year", "(NOT starts_with(o_orderpriority, '1') OR delay_days <= 365)"),
)


def _waterfall_sql() -> str:
    """The stages as separate filtered counts, which is what the single pass must equal."""
    stages = ["SELECT 0 AS step_no, 'raw' AS step, count(*) AS row_count FROM shipments"]
    for i, (label, _) in enumerate(RULES, start=1):
        kept = " AND ".join(f"({p})" for _, p in RULES[:i])
        stages.append(
            f"SELECT {i} AS step_no, '{label}' AS step, count(*) AS row_count FROM shipments WHERE {kept}"
        )
    return f"""WITH {SHIPMENTS}, s AS ({' UNION ALL '.join(stages)})
    SELECT step_no, step, row_count, lag(row_count) OVER (ORDER BY step_no) - row_count AS removed,
      round(100.0::DOUBLE * row_count / first_value(row_count) OVER (ORDER BY step_no), 3) AS pct_of_raw FROM s"""


ALL_RULES = " AND ".join(f"({p})" for _, p in RULES)


@query("rule_waterfall", _waterfall_sql())
def waterfall(spark, sf_dir):
    return rule_waterfall(shipments.shipments(spark, sf_dir), shipments.rules())


@query(
    "rule_waterfall_by_priority",
    f"""WITH {SHIPMENTS} SELECT o_orderpriority, count(*) AS raw_rows, count(*) FILTER ({ALL_RULES}) AS kept_rows
    FROM shipments GROUP BY o_orderpriority""",
)
def waterfall_by_priority(spark, sf_dir):
    steps = rule_waterfall(
        shipments.shipments(spark, sf_dir), shipments.rules(), by=["o_orderpriority"]
    )
    return steps.groupBy("o_orderpriority").agg(
        F.max("row_count").alias("raw_rows"), F.min("row_count").alias("kept_rows")
    )


@query(
    "rules_applied",
    f"""WITH {SHIPMENTS} SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS ship_month,
      line_code IS NULL OR line_code = 99 AS code_missing, status IS NULL AS status_missing,
      coalesce(line_code = 2, false) AS second_line, round(unit_price, 6) AS unit_price
    FROM shipments WHERE {ALL_RULES}""",
)
def rules_applied(spark, sf_dir):
    kept = apply_rules(shipments.shipments(spark, sf_dir), shipments.rules())
    return rounded(
        kept.select(
            "l_orderkey",
            "l_linenumber",
            F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
            flag_missing("line_code", [study.CODE_UNKNOWN]).alias("code_missing"),
            flag_missing("status").alias("status_missing"),
            flag_equals("line_code", 2).alias("second_line"),
            "unit_price",
        )
    )


@query(
    "null_admitting",
    """WITH l AS (SELECT NULLIF(l_linenumber, 7) AS code FROM lineitem)
    SELECT count(*) AS raw_rows, count(*) FILTER (code IN (1, 2, 3)) AS bare_isin,
      count(*) FILTER (code IS NULL OR code IN (1, 2, 3)) AS null_admitted,
      count(*) FILTER (NOT (code = 1)) AS bare_not_equal,
      count(*) FILTER (code IS DISTINCT FROM 1) AS null_safe_not_equal FROM l""",
)
def null_admitting(spark, sf_dir):
    code = F.nullif("l_linenumber", F.lit(7))
    lines = study.table(spark, sf_dir, "lineitem").select(code.alias("code"))
    listed = F.col("code").isin(1, 2, 3)
    rules = {
        "bare_isin": listed,
        "null_admitted": F.col("code").isNull() | listed,
        "bare_not_equal": ~(F.col("code") == 1),
        "null_safe_not_equal": ~F.col("code").eqNullSafe(1),
    }
    return lines.agg(
        F.count("*").alias("raw_rows"), *[F.count_if(p).alias(n) for n, p in rules.items()]
    )


@query(
    "missing_profile",
    """SELECT l_returnflag, CASE WHEN l_suppkey % 10 IN (0, 1) THEN 'near' WHEN l_suppkey % 10 = 9 THEN 'unknown' ELSE 'other' END AS zone_group,
      count(*) AS row_count, round(avg(CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_status_missing,
      round(avg(CASE WHEN l_discount = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_no_discount
    FROM lineitem WHERE l_linenumber = 7 GROUP BY 1, 2""",
)
def missing_metadata(spark, sf_dir):
    lines = study.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_discount",
        F.nullif("l_linenumber", F.lit(7)).alias("line_code"),
        F.nullif("l_linestatus", F.lit("F")).alias("status"),
        (F.col("l_suppkey") % 10).alias("zone"),
    )
    zone = label_case("zone", {"near": [0, 1], "unknown": [9]}, "other").alias("zone_group")
    return rounded(
        missing_profile(
            lines,
            flag_missing("line_code", [study.CODE_UNKNOWN]),
            ["l_returnflag", zone],
            {
                "share_status_missing": F.col("status").isNull(),
                "share_no_discount": F.col("l_discount") == 0,
            },
        )
    )


@query(
    "share_where",
    """SELECT count(*) AS row_count, round(avg(CASE WHEN s.s_nationkey = 7 OR c.c_nationkey = 7 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_touching
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE l.l_linenumber = 2""",
)
def share_touching(spark, sf_dir):
    """Share of coded rows that touch a zone at either end (supplier or customer nation)."""
    lines = study.table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") == 2)
    ends = lines.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n"))
    customers = study.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("to_zone")
    )
    orders = study.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    suppliers = study.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("from_zone")
    )
    both = (
        ends.join(orders, on="l_orderkey", how="left")
        .join(customers, on="o_custkey", how="left")
        .join(suppliers, on="l_suppkey", how="left")
    )
    touching = (F.col("from_zone") == 7) | (F.col("to_zone") == 7)
    return rounded(
        both.agg(
            F.sum("n").alias("row_count"),
            F.try_divide(
                F.sum(F.when(touching, F.col("n")).otherwise(0)).cast("double"), F.sum("n")
            ).alias("share_touching"),
        )
    )


@query(
    "share_where_one_side",
    """SELECT count(*) AS row_count, round(avg(CASE WHEN l_tax > 0.05 OR l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS share_taxed
    FROM lineitem WHERE l_returnflag = 'R'""",
)
def share_one_side(spark, sf_dir):
    lines = study.table(spark, sf_dir, "lineitem")
    condition = (F.col("l_tax") > 0.05) | (F.col("l_discount") > 0.05)
    return rounded(share_where(lines, F.col("l_returnflag") == "R", condition, "share_taxed"))


@query(
    "min_support",
    f"""WITH {HOURS} SELECT date, hour, entity, n_events, CASE WHEN n_events >= 3 THEN round(mean_value, 6) END AS mean_value FROM hours""",
)
def supported_means(spark, sf_dir):
    return rounded(
        min_support(
            entity_hours(spark, sf_dir).drop("sum_value"), "n_events", 3, columns=["mean_value"]
        )
    )


@query(
    "labelled_trips",
    """SELECT CASE WHEN l_linenumber IN (1, 2) THEN 'early' WHEN l_linenumber IN (3, 4) THEN 'middle' ELSE 'late' END AS stage,
      (l_suppkey % 24 >= 22 OR l_suppkey % 24 < 6) AS is_night, count(*) AS row_count,
      round(sum(CASE WHEN l_discount > 0 THEN l_tax / l_discount END), 4) AS sum_tax_per_discount
    FROM lineitem GROUP BY 1, 2""",
)
def labelled(spark, sf_dir):
    lines = study.table(spark, sf_dir, "lineitem").select(
        label_case("l_linenumber", {"early": [1, 2], "middle": [3, 4]}, "late").alias("stage"),
        in_wrapped_range(F.col("l_suppkey") % 24, 22, 6).alias("is_night"),
        guarded_rate("l_tax", "l_discount").alias("rate"),
    )
    return rounded(
        lines.groupBy("stage", "is_night").agg(
            F.count("*").alias("row_count"), F.sum("rate").alias("sum_tax_per_discount")
        ),
        4,
    )
