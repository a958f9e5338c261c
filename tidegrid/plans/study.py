"""The study over the driver's tables: window, entities, and views shaped like the feeds.

``events`` stands for the trip feed (entity = ``event_type``, value = fare) and, read as legs
that take ``value`` minutes, for the feed with ``hhmm`` clocks. The code in ``props`` drives
the flags. Everything is row-level projection over a whole table; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.clock import to_hhmm
from tidegrid.functions.columns import between_half_open

START, END, CUT = "2024-01-01", "2024-01-31", "2024-01-22"
DAYS = 30
ENTITIES = ("click", "error", "purchase", "signup", "view")
CELLS = DAYS * 24 * len(ENTITIES)
KEY = ["date", "hour", "entity"]

# Days of the window treated as holidays, with their kind.
HOLIDAYS = (
    ("2024-01-01", "New Year's Day", "federal"),
    ("2024-01-02", "Day after New Year", "adjacent"),
    ("2024-01-15", "Martin Luther King Jr. Day", "federal"),
)

# Codes of the stand-in feed.
CODE_UNKNOWN = 99
CODE_FLAT = 2
CARD_BELOW = 60
FLEX_BELOW = 5
LONG_HAUL = 200.0
LATE_MINUTES = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e,) for e in ENTITIES], "entity string")


def holidays(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        list(HOLIDAYS), "day string, holiday_name string, holiday_kind string"
    )
    return rows.select(F.to_date("day").alias("date"), "holiday_name", "holiday_kind")


def parsed_once(df: DataFrame, *columns: str, **computed: Column) -> DataFrame:
    """Keep columns and add computed ones as columns of their own.

    ``inline`` of one struct is a generator, which Spark neither merges into later projections
    nor pushes predicates through, so a parse is done once per row and not once per use.
    """
    row = F.struct(*[c.alias(name) for name, c in computed.items()])
    return df.select(*columns, F.inline(F.array(row)))


def in_window(ts: str = "ts"):
    return between_half_open(
        ts, F.lit(START).cast("timestamp_ntz"), F.lit(END).cast("timestamp_ntz")
    )


def trips(spark: SparkSession, sf_dir: str, coded: bool = True) -> DataFrame:
    """Events of the window as trips, with nulls where a field was not recorded.

    Without the code, ``props`` is neither read nor parsed.
    """
    events = table(spark, sf_dir, "events").where(in_window())
    plain = [
        "event_id",
        "user_id",
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("entity"),
        F.col("value").alias("fare"),
    ]
    if not coded:
        return events.select(*plain)
    names = ["event_id", "user_id", "date", "hour", "entity", "fare"]
    code = F.get_json_object("props", "$.k").cast("int")
    return parsed_once(events.select(*plain, "props"), *names, code=code).select(
        "*",
        F.nullif(F.col("code") % 7, F.lit(0)).alias("passengers"),
        F.nullif(F.col("code") % 10, F.lit(9)).alias("rate_code"),
        (F.col("fare") + F.col("code") / 4.0).alias("total"),
        (F.col("fare") * 0.15 + F.col("code") / 100.0).alias("tip"),
    )


def arrival_in_window() -> Column:
    """On the raw timestamp: a leg that arrives inside the window leaves at most a day before it."""
    start = F.lit(START).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    return between_half_open("ts", start, F.lit(END).cast("timestamp_ntz"))


def legs(spark: SparkSession, sf_dir: str, only: Column | None = None) -> DataFrame:
    """Events as legs with ``hhmm`` clocks: departure at ``ts``, arrival ``value`` minutes on.

    Midnight is written 2400, as such feeds do. Some scheduled clocks are missing, some legs
    are cancelled (no actual clock) or diverted (no delay). ``only`` is a predicate on the raw
    events, which reaches the scan; nothing is pushed through the parse.
    """
    events = table(spark, sf_dir, "events")
    events = events if only is None else events.where(only)
    late = F.greatest(F.col("code") - 80, F.lit(0))
    base = parsed_once(
        events,
        "event_id",
        entity=F.col("event_type"),
        leg_date=F.to_date("ts"),
        dep_minute=F.hour("ts") * 60 + F.minute("ts"),
        block=F.floor("value").cast("int"),
        distance=F.col("value") * 2.0,
        code=F.get_json_object("props", "$.k").cast("int"),
    )
    cancelled, diverted = F.col("code") < 3, F.col("code") == 99
    arrival = (F.col("dep_minute") + F.col("block")) % 1440
    actual = (F.col("dep_minute") + F.col("block") + late) % 1440
    return parsed_once(
        base,
        "event_id",
        "entity",
        "leg_date",
        "distance",
        "block",
        dep_hhmm=to_hhmm("dep_minute", midnight_last=True),
        arr_hhmm=F.when(F.col("code") != 50, to_hhmm(arrival, midnight_last=True)),
        act_hhmm=F.when(~cancelled, to_hhmm(actual, midnight_last=True)),
        delay=F.when(~cancelled & ~diverted, late.cast("double")),
        cancelled=cancelled.cast("double"),
        diverted=F.when(F.col("code") != 98, diverted.cast("double")),
    )
