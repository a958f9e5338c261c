"""Lagged correlation, matched comparison, event days and baselines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.history import hourly_window


def lag_correlation(
    df: DataFrame,
    x: str,
    y: str,
    lags: Sequence[int],
    entity: Sequence[str],
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Correlation of ``x`` with ``y`` shifted by each lag, per entity, over the grid.

    A positive lag pairs ``x`` with the ``y`` of that many hours before.
    """
    window = hourly_window(entity, date, hour)
    shifted = df.select(
        *entity,
        F.col(x).cast("double").alias("_x"),
        *[F.lag(y, n).over(window).cast("double").alias(f"y{i}") for i, n in enumerate(lags)],
    )
    wide = shifted.groupBy(*entity).agg(
        *[F.corr("_x", f"y{i}").alias(f"c{i}") for i in range(len(lags))]
    )
    rows = [
        F.struct(F.lit(n).alias("lag_hours"), F.col(f"c{i}").alias("correlation"))
        for i, n in enumerate(lags)
    ]
    return wide.select(*entity, F.inline(F.array(*rows)))


def peak_lag(table: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Lag of the largest correlation per entity; the smallest lag on a tie."""
    return table.where(F.col("correlation").isNotNull()).groupBy(*entity).agg(
        F.min_by("lag_hours", F.struct(-F.col("correlation"), "lag_hours")).alias("peak_lag"),
        F.max("correlation").alias("peak_correlation"),
    )


def matched_cells(
    df: DataFrame, condition: Column, cell: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """Per-cell means under and outside a condition, from one conditional aggregate.

    ``values`` maps output names to columns. Only cells seen on both sides are kept, which is
    what an inner join of the two halves would give.
    """
    measures = [
        F.count(F.when(condition, 1)).alias("rows_on"),
        F.count(F.when(~condition, 1)).alias("rows_off"),
    ]
    for name, column in values.items():
        measures += [
            F.avg(F.when(condition, F.col(column))).alias(f"{name}_on"),
            F.avg(F.when(~condition, F.col(column))).alias(f"{name}_off"),
        ]
    cells = df.groupBy(*cell).agg(*measures)
    return cells.where((F.col("rows_on") > 0) & (F.col("rows_off") > 0)).select(
        "*", *[(F.col(f"{n}_on") - F.col(f"{n}_off")).alias(f"{n}_delta") for n in values]
    )


def _weighted(value: Column, weight: Column) -> Column:
    """Weighted mean over rows where the value is present."""
    used = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value * weight), F.sum(used).cast("double"))


def matched_compare(
    cells: DataFrame, by: Sequence[str], values: Sequence[str], weight: str = "rows_on"
) -> DataFrame:
    """Exposure-weighted difference of matched cells, in units and in percent.

    The percentage is a ratio of weighted aggregates, so a near-empty cell cannot dominate it.
    """
    w = F.col(weight)
    measures = [F.sum(weight).alias("exposure"), F.count("*").alias("cells")]
    for name in values:
        delta, base = F.col(f"{name}_delta"), F.col(f"{name}_off")
        measures += [
            _weighted(delta, w).alias(f"{name}_delta"),
            (F.lit(100.0) * F.try_divide(_weighted(delta, w), _weighted(base, w))).alias(
                f"{name}_pct"
            ),
        ]
    return cells.groupBy(*by).agg(*measures)


def t_p_value(t: Column, dof: Column) -> Column:
    """Two-sided Student t probability for whole degrees of freedom.

    With ``theta = atan(|t| / sqrt(dof))`` the central probability is a finite cosine series
    whose length is half the degrees of freedom.
    """
    theta = F.atan(F.abs(t) / F.sqrt(dof.cast("double")))
    cos2 = F.pow(F.cos(theta), F.lit(2.0))
    odd = dof % 2 == 1
    terms = F.floor((dof - F.when(odd, 3).otherwise(2)) / 2).cast("int")
    first = F.when(odd, F.cos(theta)).otherwise(F.lit(1.0))
    step = F.when(odd, F.lit(0)).otherwise(F.lit(-1))
    series = F.aggregate(
        F.when(terms >= 1, F.sequence(F.lit(1), F.greatest(terms, F.lit(1)))).otherwise(
            F.array().cast("array<int>")
        ),
        F.struct(first.alias("term"), first.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * cos2 * (2 * k + step) / (2 * k + 1 + step)).alias("term"),
            (
                acc["total"] + acc["term"] * cos2 * (2 * k + step) / (2 * k + 1 + step)
            ).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    two_over_pi = F.lit(2.0) / F.pi()
    inside = (
        F.when(dof == 1, two_over_pi * theta)
        .when(odd, two_over_pi * (theta + F.sin(theta) * series))
        .otherwise(F.sin(theta) * series)
    )
    return F.when(dof >= 1, F.greatest(F.lit(1.0) - inside, F.lit(0.0)))


def t_statistic(df: DataFrame, delta: str, by: Sequence[str]) -> DataFrame:
    """One-sample t of the cell differences against zero, with its two-sided probability."""
    stats = df.groupBy(*by).agg(
        F.count(delta).alias("n"), F.avg(delta).alias("mean_delta"), F.stddev_samp(delta).alias("sd")
    )
    t = F.try_divide(F.col("mean_delta"), F.col("sd") / F.sqrt(F.col("n").cast("double")))
    return stats.select("*", t.alias("t")).select("*", t_p_value(F.col("t"), F.col("n") - 1).alias("p_value"))


def baseline_ratio(
    df: DataFrame, actual: str, baseline: str, by: Sequence[str], where: Column, tolerance: float = 0.05
) -> DataFrame:
    """A trailing mean must average what the series averages; flags groups outside tolerance."""
    means = df.where(where).groupBy(*by).agg(
        F.avg(actual).alias("mean_actual"), F.avg(baseline).alias("mean_baseline")
    )
    ratio = F.try_divide(F.col("mean_baseline"), F.col("mean_actual"))
    return means.select("*", ratio.alias("ratio")).select(
        "*",
        F.coalesce(F.col("ratio").between(1 - tolerance, 1 + tolerance), F.lit(False)).alias("sound"),
    )


def extreme_day(df: DataFrame, intensity: str, date: str = "date") -> Column:
    """Date of the largest daily mean of a column (earliest on a tie), as a scalar subquery."""
    daily = df.groupBy(date).agg(F.avg(intensity).alias("_i")).where(F.col("_i").isNotNull())
    return daily.agg(F.min_by(F.col(date), F.struct(-F.col("_i"), F.col(date)))).scalar()


def event_day_compare(
    df: DataFrame,
    intensity: str,
    value: str,
    trailing: str,
    days: int = 28,
    date: str = "date",
    weekday: str = "day_of_week",
) -> DataFrame:
    """The most extreme day against its trailing norm and the same weekday within ``days``."""
    day = extreme_day(df, intensity, date)
    marked = df.select(date, weekday, value, trailing, day.alias("_day"))
    on_day = F.col(date) == F.col("_day")
    nearby = (
        ~on_day
        & (F.abs(F.datediff(F.col(date), F.col("_day"))) <= days)
        & (F.weekday(F.col(date)) == F.weekday("_day"))
    )
    row = marked.agg(
        F.max("_day").alias("event_date"),
        F.sum(F.when(on_day, F.col(value))).cast("double").alias("observed"),
        F.sum(F.when(on_day, F.col(trailing))).alias("trailing_norm"),
        F.sum(F.when(nearby, F.col(value))).cast("double").alias("_near"),
        F.count_distinct(F.when(nearby, F.col(date))).alias("seasonal_days"),
    )
    seasonal = F.try_divide(F.col("_near"), F.col("seasonal_days").cast("double"))

    def change(norm: Column) -> Column:
        return F.lit(100.0) * (F.try_divide(F.col("observed"), norm) - 1)

    return row.select(
        "event_date",
        "observed",
        "trailing_norm",
        change(F.col("trailing_norm")).alias("vs_trailing_pct"),
        seasonal.alias("seasonal_norm"),
        change(seasonal).alias("vs_seasonal_pct"),
        "seasonal_days",
    )


def event_day_profile(
    df: DataFrame,
    intensity: str,
    value: str,
    by: Sequence[str],
    days: int = 28,
    date: str = "date",
) -> DataFrame:
    """The extreme day hour by hour beside the mean of the same weekday nearby."""
    day = extreme_day(df, intensity, date)
    marked = df.select(*by, date, value, day.alias("_day"))
    on_day = F.col(date) == F.col("_day")
    nearby = (
        ~on_day
        & (F.abs(F.datediff(F.col(date), F.col("_day"))) <= days)
        & (F.weekday(F.col(date)) == F.weekday("_day"))
    )
    return marked.groupBy(*by).agg(
        F.sum(F.when(on_day, F.col(value))).alias("observed"),
        F.avg(F.when(nearby, F.col(value))).alias("seasonal_mean"),
    )
