import datetime as dt

from pyspark.sql import functions as F

from tidegrid.functions.clock import (
    clock_key,
    dst_kind,
    duration_seconds,
    hhmm_minutes,
    implied_block,
    to_hhmm,
    utc_to_local,
    valid_hhmm,
)
from tidegrid.functions.columns import cyclical, flag_equals, flag_missing, guarded_rate, in_wrapped_range
from tidegrid.functions.calendar import iso_weekday, split_by_date
from tidegrid.operators.grid import hour_grid

D = dt.date(2024, 1, 10)


def test_hhmm_validity(spark):
    df = spark.createDataFrame([(2400,), (1260,), (None,), (-1,), (0,), (2401,)], "t int")
    assert [r[0] for r in df.select(valid_hhmm("t")).collect()] == [True, False, False, False, True, False]


def test_midnight_is_remapped_before_the_overnight_shift(spark):
    df = spark.createDataFrame(
        [(D, 2230, 2400), (D, 2230, 105), (D, 900, 1130), (D, 2400, 130), (D, 900, None)],
        "d date, dep int, arr int",
    )
    keyed = clock_key(df, "d", "arr", "dep", "s").select("s_date", "s_hour")
    assert [tuple(r) for r in keyed.collect()] == [
        (dt.date(2024, 1, 11), 0),
        (dt.date(2024, 1, 11), 1),
        (D, 11),
        (D, 1),
        (D, None),
    ]


def test_implied_block_lies_in_one_day(spark):
    df = spark.createDataFrame(
        [(D, 2230, 2400), (D, 2359, 2358), (D, 905, 905)], "d date, dep int, arr int"
    )
    keyed = clock_key(df, "d", "arr", "dep", "s")
    block = keyed.select(implied_block("d", "s_date", "dep", "arr")).collect()
    assert [r[0] for r in block] == [90, 1439, 0]


def test_hhmm_round_trip(spark):
    df = spark.range(1440).select(F.col("id").cast("int").alias("m"))
    both = df.select("m", hhmm_minutes(to_hhmm("m")).alias("back"), to_hhmm("m", midnight_last=True).alias("h"))
    rows = both.collect()
    assert all(r["m"] == r["back"] for r in rows)
    assert {r["h"] for r in rows if r["m"] == 0} == {2400}
    assert next(r["h"] for r in rows if r["m"] == 545) == 905


def test_dst_hours_come_from_the_zone(spark):
    grid = hour_grid(spark, "2023-01-01", "2024-07-01")
    found = grid.select("date", "hour", dst_kind("date", "hour", "America/New_York").alias("k")).where(
        F.col("k").isNotNull()
    )
    assert {(str(r["date"]), r["hour"], r["k"]) for r in found.collect()} == {
        ("2023-03-12", 2, "skipped"),
        ("2024-03-10", 2, "skipped"),
        ("2023-11-05", 1, "repeated"),
    }


def test_two_utc_hours_share_the_repeated_local_hour(spark):
    df = spark.createDataFrame([("2023-11-05 05:30:00",), ("2023-11-05 06:30:00",)], "t string").select(
        utc_to_local(F.col("t").cast("timestamp_ntz"), "America/New_York").alias("l")
    )
    assert df.distinct().count() == 1


def test_small_builders(spark):
    df = spark.createDataFrame([(23, 99, 4.0, 0.0), (6, None, 4.0, 2.0)], "h int, c int, a double, b double")
    rows = df.select(
        in_wrapped_range("h", 22, 6).alias("night"),
        flag_missing("c", [99]).alias("missing"),
        flag_equals("c", 99).alias("is99"),
        guarded_rate("a", "b").alias("rate"),
        cyclical("h", 24)[0].alias("s"),
    ).collect()
    assert [tuple(r)[:4] for r in rows] == [(True, True, True, None), (False, True, False, 2.0)]
    assert abs(rows[1]["s"] - 1.0) < 1e-12


def test_calendar_and_duration(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 7), "2023-11-05 00:30:00", "2023-11-05 03:30:00")], "d date, a string, b string"
    ).select("d", F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    row = df.select(
        iso_weekday("d"), split_by_date("d", "2024-01-07"), duration_seconds("a", "b")
    ).head()
    assert tuple(row) == (7, "test", 10800)
