"""Lags, trailing means and neighbours over a completed grid.

On a complete grid a positional lag is a wall-clock lag. Window partitions are an entity, or
an entity and an hour of day, of the grid: their size is the number of hours or days in the
window, never the number of raw events. All features of one window spec share one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hourly_window(entity: Sequence[str], date: str = "date", hour: str = "hour"):
    return W.partitionBy(*entity).orderBy(date, hour)


def same_hour_window(entity: Sequence[str], days: int, date: str = "date", hour: str = "hour"):
    """The same hour over the previous ``days`` days; the current row is never inside."""
    return W.partitionBy(*entity, hour).orderBy(date).rowsBetween(-days, -1)


def add_lags(
    df: DataFrame,
    lags: Sequence[tuple[str, int, str]],
    entity: Sequence[str],
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Add ``(column, hours, name)`` lags in one projection; negative hours look ahead."""
    window = hourly_window(entity, date, hour)
    return df.select("*", *[F.lag(c, n).over(window).alias(name) for c, n, name in lags])


def add_trailing_means(
    df: DataFrame,
    columns: Mapping[str, str],
    days: int,
    entity: Sequence[str],
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Add same-hour trailing means ``{column: name}``; nulls are skipped by the mean."""
    window = same_hour_window(entity, days, date, hour)
    return df.select("*", *[F.avg(c).over(window).alias(n) for c, n in columns.items()])


def add_neighbours(
    df: DataFrame, column: str, entity: Sequence[str], date: str = "date", hour: str = "hour"
) -> DataFrame:
    """The column in the previous and the next clock hour; null at the window's two ends."""
    return add_lags(
        df,
        [(column, 1, f"{column}_prev_hr"), (column, -1, f"{column}_next_hr")],
        entity,
        date,
        hour,
    )


def lag_outcomes(
    df: DataFrame,
    columns: Sequence[str],
    entity: Sequence[str],
    hours: int = 1,
    drop: bool = False,
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Lag every leaking column by ``hours`` as ``{column}_lag_{hours}h``."""
    lagged = add_lags(df, [(c, hours, f"{c}_lag_{hours}h") for c in columns], entity, date, hour)
    return lagged.drop(*columns) if drop else lagged


def history_flags(df: DataFrame, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """Boolean per flag: every listed history column is present."""

    def complete(columns: Sequence[str]) -> Column:
        out = F.col(columns[0]).isNotNull()
        for c in columns[1:]:
            out = out & F.col(c).isNotNull()
        return out

    return df.select("*", *[complete(cs).alias(name) for name, cs in flags.items()])
