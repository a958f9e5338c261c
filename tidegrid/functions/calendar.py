"""Calendar features, holidays and the forward-in-time split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import as_column, cyclical, flag_equals


def iso_weekday(date: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(as_column(date)) + 1).cast("int")


def with_calendar(df: DataFrame, date: str = "date", hour: str = "hour") -> DataFrame:
    """Weekday, day name, month, year, weekend flag and the hour as an angle."""
    sine, cosine = cyclical(hour, 24)
    weekday = iso_weekday(date)
    return df.select(
        "*",
        weekday.alias("day_of_week"),
        F.date_format(F.col(date), "EEE").alias("day_name"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        (weekday >= 6).alias("is_weekend"),
        sine.alias("hour_sin"),
        cosine.alias("hour_cos"),
    )


def with_holidays(df: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Join ``(date, holiday_name, holiday_kind)`` and turn the kind into null-safe flags.

    A date given twice is an error, so no row of ``df`` is doubled and the calendar bounds what
    is broadcast.
    """
    twice = F.concat(F.lit("two holidays on "), F.col(date).cast("string"))
    once = holidays.groupBy(date).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in ("holiday_name", "holiday_kind")])
    named = F.when(F.col("_n") > 1, F.raise_error(twice)).otherwise(F.col("holiday_name")).alias("holiday_name")
    joined = df.join(F.broadcast(once.select(date, named, "holiday_kind")), on=date, how="left")
    return joined.select(
        *df.columns,
        "holiday_name",
        flag_equals("holiday_kind", "federal").alias("is_holiday"),
        flag_equals("holiday_kind", "adjacent").alias("is_holiday_adjacent"),
    )


def split_by_date(date: Column | str, cut: str) -> Column:
    """``train`` before the cut, ``test`` from it on."""
    return F.when(as_column(date) < F.lit(cut).cast("date"), F.lit("train")).otherwise(
        F.lit("test")
    )
