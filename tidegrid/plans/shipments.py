"""Order lines as a feed with business rules: which lines are regular sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.columns import guarded_rate
from tidegrid.operators.rules import Rule
from tidegrid.plans.study import table

LONGEST_DAYS = 730
URGENT_DAYS = 365
MOST_DISCOUNT, MOST_TAX = 0.08, 0.07
LEAST_NET, LEAST_UNIT = 2000.0, 100.0


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's date and priority, delay in days, unit price and net value.

    A row-level join on the order key: neither side is assumed small, and adaptive skew
    handling splits an order key that holds a large share of the lines.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "o_custkey"
    )
    joined = lines.join(orders, on="l_orderkey", how="left")
    days = F.datediff("l_shipdate", "o_orderdate")
    return joined.select(
        "*",
        days.alias("delay_days"),
        guarded_rate("l_extendedprice", F.col("l_quantity")).alias("unit_price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_value"),
        F.nullif("l_linenumber", F.lit(7)).alias("line_code"),
        F.nullif("l_linestatus", F.lit("F")).alias("status"),
    )


def rules() -> list[Rule]:
    """Which lines count as regular sales; rules on the line alone come before those on its order."""
    return [
        ("discount within policy", F.col("l_discount") <= MOST_DISCOUNT),
        ("tax within policy", F.col("l_tax") <= MOST_TAX),
        ("not returned while open", ~((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))),
        ("unit price worth a line", F.col("unit_price") >= LEAST_UNIT),
        ("net value worth a shipment", F.col("net_value") >= LEAST_NET),
        ("not shipped before the order", F.col("delay_days") >= 0),
        ("shipped within two years", F.col("delay_days") <= LONGEST_DAYS),
        (
            "urgent orders within one year",
            ~F.col("o_orderpriority").startswith("1") | (F.col("delay_days") <= URGENT_DAYS),
        ),
    ]
