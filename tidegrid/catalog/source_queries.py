"""Drifting files, month partitions, coverage, reduction at ingest and stable samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.plans import study
from tidegrid.plans.entity_hours import entity_hours
from tidegrid.sources.months import coverage_report, missing_months, month_partitions
from tidegrid.sources.readers import (
    FeedSpec,
    harmonise,
    load_union,
    read_parquet,
    reduce_feed,
    retention_report,
    stable_sample,
    union_frames,
)

FEED = FeedSpec(integers=("user_id", "code"), doubles=("value",))


@query(
    "harmonised_union",
    """SELECT CAST(date_trunc('day', ts) AS DATE) AS date, event_type, count(*) AS row_count, count(DISTINCT CAST(user_id AS INTEGER)) AS users,
      round(sum(CASE WHEN ts < TIMESTAMP '2024-01-11' OR ts >= TIMESTAMP '2024-01-21' THEN value ELSE floor(value) END), 4) AS value
    FROM events GROUP BY 1, 2""",
)
def harmonised_union(spark, sf_dir):
    """Three ten-day frames whose names and types drift, settled on one schema."""
    events = study.table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-21"))
    upper = events.where(F.col("ts") < first).select(
        "ts", "user_id", F.col("event_type").alias("Event_Type"), F.col("value").alias("Value")
    )
    whole = events.where((F.col("ts") >= first) & (F.col("ts") < second)).select(
        F.floor("value").alias("VALUE"), "event_type", F.col("user_id").cast("int").alias("User_ID"), "ts"
    )
    plain = events.where(F.col("ts") >= second)
    feed = union_frames([harmonise(f, FEED) for f in (upper, whole, plain)])
    return rounded(
        feed.groupBy(F.to_date("ts").alias("date"), "event_type").agg(
            F.count("*").alias("row_count"),
            F.count_distinct("user_id").alias("users"),
            F.sum("value").alias("value"),
        ),
        4,
    )


@query(
    "month_partitions",
    """WITH m AS (SELECT CAST(d AS DATE) AS month_start FROM range(TIMESTAMP '1995-12-01', TIMESTAMP '1998-01-01', INTERVAL 1 MONTH) t(d)),
    c AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(month_start, '%Y-%m') AS month, month_start, CAST(month_start + INTERVAL 1 MONTH AS DATE) AS month_end,
      month_start < DATE '1996-01-01' AS is_lead, coalesce(n, 0) AS orders
    FROM m LEFT JOIN c ON c.month = strftime(month_start, '%Y-%m')""",
)
def months(spark, sf_dir):
    counts = study.table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(F.count("*").alias("orders"))
    wanted = month_partitions(spark, "1996-01-01", "1998-01-01", lead=1)
    return wanted.join(counts, on="month", how="left").fillna(0, subset=["orders"])


@query(
    "missing_months",
    """WITH m AS (SELECT CAST(d AS DATE) AS s FROM range(TIMESTAMP '2001-01-01', TIMESTAMP '2002-01-01', INTERVAL 1 MONTH) t(d))
    SELECT strftime(s, '%Y-%m') AS month FROM m WHERE strftime(s, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders)""",
)
def absent_months(spark, sf_dir):
    present = study.table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    required = month_partitions(spark, "2001-02-01", "2002-01-01", lead=1).select("month")
    return missing_months(present, required)


@query(
    "coverage",
    """WITH e AS (SELECT event_type, CAST(ts AS DATE) AS date, hour(ts) AS hour, value,
      NULLIF(CAST(json_extract_string(props, '$.k') AS INTEGER) % 7, 0) AS passengers FROM events)
    SELECT event_type, count(*) AS row_count, count(DISTINCT (date, hour)) AS hours_present, 720 - count(DISTINCT (date, hour)) AS missing_hours,
      min(date) AS first_date, max(date) AS last_date,
      round(avg(CASE WHEN value IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS value_null_rate,
      round(avg(CASE WHEN passengers IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS passengers_null_rate
    FROM e GROUP BY event_type""",
)
def coverage(spark, sf_dir):
    code = F.get_json_object("props", "$.k").cast("int")
    events = study.table(spark, sf_dir, "events").select(
        "event_type",
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        "value",
        F.nullif(code % 7, F.lit(0)).alias("passengers"),
    )
    return rounded(
        coverage_report(
            events, ["event_type"], ["date", "hour"], ["value", "passengers"], study.DAYS * 24
        )
    )


@query(
    "reduced_feed",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag IN ('R') OR l_linestatus IN ('F')""",
)
def reduced(spark, sf_dir):
    lines = study.table(spark, sf_dir, "lineitem")
    keep = F.col("l_returnflag").isin("R") | F.col("l_linestatus").isin("F")
    return reduce_feed(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"], keep)


@query(
    "retention",
    """SELECT strftime(l_shipdate, '%Y') AS year, count(*) AS rows_read, count(*) FILTER (l_returnflag IN ('R') OR l_linestatus IN ('F')) AS rows_kept,
      round(100.0::DOUBLE * count(*) FILTER (l_returnflag IN ('R') OR l_linestatus IN ('F')) / count(*), 6) AS pct_kept
    FROM lineitem GROUP BY 1""",
)
def retention(spark, sf_dir):
    lines = study.table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy").alias("year"), "l_returnflag", "l_linestatus"
    )
    keep = F.col("l_returnflag").isin("R") | F.col("l_linestatus").isin("F")
    return rounded(retention_report(lines, keep, ["year"]))


@query(
    "loaded_union",
    "SELECT event_type, count(*) AS row_count, count(DISTINCT CAST(user_id AS INTEGER)) AS users, round(sum(value), 4) AS value FROM events GROUP BY event_type",
)
def loaded_union(spark, sf_dir):
    """The event feed through the loader of drifting files."""
    events = load_union(spark, f"{sf_dir}/events.parquet", FEED)
    return rounded(
        events.groupBy("event_type").agg(
            F.count("*").alias("row_count"), F.count_distinct("user_id").alias("users"), F.sum("value").alias("value")
        ),
        4,
    )


@query(
    "read_with_casts",
    """SELECT o_orderstatus, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS BIGINT)) AS BIGINT) AS whole_price,
      min(CAST(o_orderkey AS VARCHAR)) AS first_key FROM (SELECT * REPLACE (trunc(o_totalprice) AS o_totalprice) FROM orders) GROUP BY o_orderstatus""",
)
def read_with_casts(spark, sf_dir):
    orders = read_parquet(
        spark, f"{sf_dir}/orders.parquet", casts={"o_orderkey": "string", "o_totalprice": "bigint"}
    )
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"), F.sum("o_totalprice").alias("whole_price"), F.min("o_orderkey").alias("first_key")
    )


@query(
    "stable_sample",
    """SELECT event_id, event_type, value FROM events
    WHERE CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) < CAST(floor(0.01 * 4294967296) AS BIGINT)""",
)
def sampled(spark, sf_dir):
    events = study.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return stable_sample(events, "event_id", 0.01)


@query(
    "hour_coverage",
    f"""WITH {HOURS} SELECT date, count(*) AS cells, count(*) FILTER (n_events > 0) AS filled FROM hours GROUP BY date""",
)
def hour_coverage(spark, sf_dir):
    return entity_hours(spark, sf_dir).groupBy("date").agg(
        F.count("*").alias("cells"), F.count_if(F.col("n_events") > 0).alias("filled")
    )
