"""Clock arithmetic: ``hhmm`` integers, overnight shifts, local time and DST.

Wall-clock times are ``timestamp_ntz`` throughout, so no result depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import as_column

MINUTES_PER_DAY = 1440


def valid_hhmm(column: Column | str) -> Column:
    """True for a clock reading in [0, 2400] with a minute part below 60; never null."""
    col = as_column(column)
    return F.coalesce(col.between(0, 2400) & (col % 100 < 60), F.lit(False))


def midnight_to_zero(column: Column | str) -> Column:
    """The feed writes midnight as 2400; read it as the start of a day."""
    col = as_column(column)
    return F.when(col == 2400, F.lit(0)).otherwise(col)


def hhmm_hour(column: Column | str) -> Column:
    return F.floor(as_column(column) / 100).cast("int")


def hhmm_minutes(column: Column | str) -> Column:
    """Minute of the day of an ``hhmm`` reading: each full hour is written 40 too high."""
    col = as_column(column)
    return (col - F.floor(col / 100) * 40).cast("int")


def to_hhmm(minute_of_day: Column | str, midnight_last: bool = False) -> Column:
    """``hhmm`` of a minute of the day; ``midnight_last`` writes 00:00 as 2400."""
    minute = as_column(minute_of_day)
    if midnight_last:
        minute = (minute + (MINUTES_PER_DAY - 1)) % MINUTES_PER_DAY + 1
    return (minute + F.floor(minute / 60) * 40).cast("int")


def clock_key(
    df: DataFrame, date: str, arrival: str, departure: str, prefix: str
) -> DataFrame:
    """Add ``{prefix}_hhmm``, ``{prefix}_date`` and ``{prefix}_hour`` of the arrival.

    Midnight is remapped first, on both readings, so that a 22:30 departure arriving at 2400
    compares as 0 < 2230 and moves to the next day. Each reading appears once per derived
    column, which keeps the predicates Spark pushes through this projection short.
    """
    arr = midnight_to_zero(arrival)
    dep = midnight_to_zero(departure)
    day = F.col(date)
    return df.select(
        "*",
        arr.alias(f"{prefix}_hhmm"),
        F.date_add(day, F.coalesce((arr < dep).cast("int"), F.lit(0))).alias(f"{prefix}_date"),
        hhmm_hour(arr).alias(f"{prefix}_hour"),
    )


def implied_block(departure_date: str, arrival_date: str, departure: str, arrival: str) -> Column:
    """Minutes between the two clock readings once the overnight shift is counted."""
    return (
        F.datediff(F.col(arrival_date), F.col(departure_date)) * MINUTES_PER_DAY
        + hhmm_minutes(midnight_to_zero(arrival))
        - hhmm_minutes(midnight_to_zero(departure))
    )


def duration_seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def wall_clock(date: Column | str, hour: Column | str) -> Column:
    """``timestamp_ntz`` of a grid hour."""
    return F.timestamp_add(
        "HOUR", as_column(hour), as_column(date).cast("timestamp_ntz")
    )


def utc_to_local(ts: Column | str, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_column(ts))


def local_to_utc(ts: Column | str, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_column(ts))


def dst_kind(date: Column | str, hour: Column | str, zone: str) -> Column:
    """``skipped`` for a grid hour the zone jumps over, ``repeated`` for one it runs twice.

    Both are read off the zone rules, so no transition date is written down: a skipped hour
    does not survive local -> UTC -> local, and a repeated one is reached from two UTC hours.
    """
    local = wall_clock(date, hour)
    utc = local_to_utc(local, zone)
    back = utc_to_local(utc, zone)
    after = utc_to_local(F.timestamp_add("HOUR", F.lit(1), utc), zone)
    before = utc_to_local(F.timestamp_add("HOUR", F.lit(-1), utc), zone)
    return F.when(back != local, F.lit("skipped")).when(
        (after == local) | (before == local), F.lit("repeated")
    )
