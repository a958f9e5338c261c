"""Bounded gap filling with provenance, peer fallback and cross-site checks.

Windows run per site over the completed hour grid: a site holds exactly one row per hour of
the window, so a window partition grows with the calendar and not with the feed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.columns import tally
from tidegrid.operators.order_stats import bracketed_counts, exact_quantiles, quantile_columns


def carry_forward(
    df: DataFrame, limits: Mapping[str, int], by: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Carry the last observation forward at most ``limit`` rows, per column.

    Each column keeps its own ``{column}_imputed`` and ``{column}_missing`` flags.
    """
    ordered = W.partitionBy(*by).orderBy(*order)
    filled = {
        c: F.last(F.col(c), ignorenulls=True).over(ordered.rowsBetween(-n, W.currentRow))
        for c, n in limits.items()
    }
    observed = df.select(
        *df.columns, *[column.alias(f"_filled_{c}") for c, column in filled.items()]
    )
    return observed.select(
        *[F.col(f"_filled_{c}").alias(c) if c in limits else F.col(c) for c in df.columns],
        *[
            (F.col(c).isNull() & F.col(f"_filled_{c}").isNotNull()).alias(f"{c}_imputed")
            for c in limits
        ],
        *[F.col(f"_filled_{c}").isNull().alias(f"{c}_missing") for c in limits],
    )


def resolve_with_source(
    df: DataFrame, column: str, peer: str, default: float, carried: str | None = None
) -> DataFrame:
    """Own value, else the peers' mean, else a constant, with a label for the one used.

    A value that was carried forward is labelled apart from one observed in its own hour.
    """
    own = F.col(column).isNotNull()
    label = F.when(own, F.lit("observed"))
    if carried is not None:
        label = F.when(own & F.col(carried), F.lit("carried")).when(own, F.lit("observed"))
    label = label.when(F.col(peer).isNotNull(), F.lit("peers")).otherwise(F.lit("assumed"))
    return df.select(
        *[
            F.coalesce(F.col(column), F.col(peer), F.lit(default)).alias(column)
            if c == column
            else F.col(c)
            for c in df.columns
        ],
        label.alias(f"{column}_source"),
    )


def with_conditions(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Add boolean conditions under three-valued logic: unknown stays null."""
    return df.select("*", *[c.alias(name) for name, c in conditions.items()])


def fill_report(
    df: DataFrame,
    by: Sequence[str],
    flags: Mapping[str, Column],
    shares: Mapping[str, Column] | None = None,
    maxima: Sequence[str] = (),
) -> DataFrame:
    """Imputation accounting per site: rows per flag, shares of conditions, maxima."""
    return df.groupBy(*by).agg(
        *[tally(c).alias(name) for name, c in flags.items()],
        *[F.avg(c.cast("double")).alias(name) for name, c in (shares or {}).items()],
        *[F.max(c).alias(f"max_{c}") for c in maxima],
    )


def collapse_duplicates(
    df: DataFrame, keys: Sequence[str], means: Sequence[str], mins: Sequence[str] = ()
) -> DataFrame:
    """One row per key: mean of measures, earliest stamp, and how many rows were merged."""
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in means],
        *[F.min(c).alias(c) for c in mins],
        F.count("*").alias("merged_rows"),
    )


def spread_check(
    df: DataFrame, keys: Sequence[str], value: str, sites: int, prob: float = 0.95
) -> DataFrame:
    """Largest minus smallest reading per hour, over hours where every site reports."""
    spread = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg((F.max(value) - F.min(value)).alias("spread"), F.count("*").alias("reporting"))
        .where(F.col("reporting") == sites)
    )
    summary = spread.agg(
        F.lit("spread").alias("metric"),
        F.count("*").alias("hours_compared"),
        F.avg("spread").alias("mean_spread"),
        F.max("spread").alias("max_spread"),
    )
    counts = bracketed_counts(spread, {"spread": F.col("spread")}, [prob])
    quantile = quantile_columns(
        exact_quantiles(counts, ["metric"], [prob], fixed_groups=True), ["metric"], {"high_spread": prob}
    )
    return summary.join(quantile, on="metric", how="left").drop("metric")
