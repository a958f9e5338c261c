"""Entity-hour aggregates, profiles and ratios. Every measure combines map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import share

Measures = Mapping[str, Column]


def aggregate_by(
    df: DataFrame, keys: Sequence[str | Column], measures: Measures, prefix: str = ""
) -> DataFrame:
    """Group by the keys and compute named aggregates, optionally prefixed.

    With fixed-size aggregates (counts, sums, means, sketches) a hot entity reaches the
    shuffle as one partial row per task and key, so its share of the feed does not matter.
    """
    return df.groupBy(*keys).agg(*[m.alias(prefix + name) for name, m in measures.items()])


def stack_keys(
    df: DataFrame,
    keyed: Mapping[str, tuple[Mapping[str, Column], Column]],
    carry: Sequence[str],
    kind: str = "kind",
) -> DataFrame:
    """A row per kind of key it qualifies for: ``(carry..., kind, key columns...)``.

    ``keyed`` maps a kind to its key columns and the condition for taking part. Aggregating the
    result with masks on ``kind`` builds several series that share rows but not keys from one
    scan and one shuffle; only partial aggregates of the stacked rows are shuffled.
    """
    rows = [
        F.struct(
            F.lit(name).alias(kind),
            *[c.alias(k) for k, c in keys.items()],
            keep.alias("_keep"),
        )
        for name, (keys, keep) in keyed.items()
    ]
    stacked = df.select(*carry, F.inline(F.array(*rows))).where(F.col("_keep"))
    return stacked.drop("_keep")


def count_by(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))


def missing_profile(
    df: DataFrame, missing: Column, by: Sequence[str | Column], shares: Measures
) -> DataFrame:
    """Profile the rows with unrecorded metadata by group, with the share of each flag."""
    return (
        df.where(missing)
        .groupBy(*by)
        .agg(F.count("*").alias("row_count"), *[share(c).alias(n) for n, c in shares.items()])
    )


def share_where(df: DataFrame, base: Column, condition: Column, name: str = "share") -> DataFrame:
    """Rows of a base population and the share of them meeting a condition."""
    return df.where(base).agg(F.count("*").alias("row_count"), share(condition).alias(name))


def regime_summary(
    df: DataFrame, regimes: Sequence[str | Column], date: str, means: Measures
) -> DataFrame:
    """Distinct days and means per regime (holiday kinds, weekend)."""
    return df.groupBy(*regimes).agg(
        F.count_distinct(F.col(date)).alias("days"), *[m.alias(n) for n, m in means.items()]
    )


def ratio_of_sums(
    df: DataFrame,
    numerator: str,
    denominator: str,
    by: Sequence[str],
    date: str | None = None,
    min_per_day: float | None = None,
) -> DataFrame:
    """Sum over sum per group (never a mean of ratios), with support per day.

    A group whose denominator averages under ``min_per_day`` keeps its sums and gets a null
    ratio, because the ratio would measure its own denominator.
    """
    measures = [F.sum(numerator).alias("numerator"), F.sum(denominator).alias("denominator")]
    if date is not None:
        measures.append(F.count_distinct(F.col(date)).alias("days"))
    out = df.groupBy(*by).agg(*measures)
    ratio = F.try_divide(F.col("numerator").cast("double"), F.col("denominator").cast("double"))
    if date is None:
        return out.select("*", ratio.alias("ratio"))
    per_day = F.col("denominator") / F.col("days")
    if min_per_day is not None:
        ratio = F.when(per_day >= min_per_day, ratio)
    return out.select("*", per_day.alias("per_day"), ratio.alias("ratio"))


def zone_flows(df: DataFrame, by: Sequence[str], sums: Measures) -> DataFrame:
    """Counts and sums per destination. Sums are carried, so any regrouping stays exact."""
    return df.groupBy(*by).agg(
        F.count("*").alias("trips"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )


def regroup_means(flows: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Regroup flows and divide summed measures by summed trips."""
    total = flows.groupBy(*by).agg(
        F.sum("trips").alias("trips"), *[F.sum(s).alias(s) for s in sums]
    )
    return total.select(
        "*",
        *[
            F.try_divide(F.col(s).cast("double"), F.col("trips")).alias("mean_" + s.removeprefix("sum_"))
            for s in sums
        ],
    )


def group_share(df: DataFrame, amount: str, by: Sequence[str], group: Sequence[str], name: str = "share_pct") -> DataFrame:
    """Share of each row of an aggregate within its group, in percent.

    Group totals are aggregated and joined back, so no group is ever gathered in one window
    partition. The null-safe join gives rows without a group their share too, and leaves both
    sides reading one aggregate.
    """
    cells = df.groupBy(*by).agg(F.sum(amount).alias(amount))
    if group:
        totals = cells.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group]).agg(
            F.sum(amount).alias("_total")
        )
        same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]
        cells = cells.join(totals, on=reduce(and_, same), how="left")
    else:
        cells = cells.select("*", cells.agg(F.sum(amount)).scalar().alias("_total"))
    return cells.select(
        *by,
        amount,
        F.try_divide(100.0 * F.col(amount), F.col("_total").cast("double")).alias(name),
    )


def mix_shift(df: DataFrame, dimension: str, flag: Column, amount: Column | None = None) -> DataFrame:
    """Shift of the mix over a dimension between two states of a flag, in percentage points."""
    weight = amount if amount is not None else F.lit(1)
    cells = df.groupBy(dimension).agg(
        F.sum(F.when(flag, weight).otherwise(0)).alias("on_amount"),
        F.sum(F.when(~flag, weight).otherwise(0)).alias("off_amount"),
    )
    totals = cells.agg(
        F.struct(F.sum("on_amount").alias("on"), F.sum("off_amount").alias("off"))
    ).scalar()
    with_total = cells.select("*", totals.alias("_total"))
    return with_total.select(
        dimension,
        "on_amount",
        "off_amount",
        (
            F.try_divide(100.0 * F.col("on_amount"), F.col("_total.on").cast("double"))
            - F.try_divide(100.0 * F.col("off_amount"), F.col("_total.off").cast("double"))
        ).alias("shift_pp"),
    )


def zone_table(
    flows: DataFrame,
    dimension: DataFrame,
    supply: DataFrame,
    zone: str,
    hours: float,
    revenue: str,
    minutes: str,
) -> DataFrame:
    """Per zone: mean revenue and minutes, revenue per engaged hour, and its own supply rate."""
    zones = regroup_means(flows, [zone], [revenue, minutes])
    mean_revenue = "mean_" + revenue.removeprefix("sum_")
    mean_minutes = "mean_" + minutes.removeprefix("sum_")
    return (
        zones.join(dimension, on=zone, how="left")
        .join(supply, on=zone, how="left")
        .select(
            *[c for c in zones.columns],
            *[c for c in dimension.columns if c != zone],
            F.try_divide(F.col("supply_count").cast("double"), F.lit(float(hours))).alias("supply_per_hour"),
            F.try_divide(F.col(mean_revenue), F.col(mean_minutes) / 60.0).alias(
                "revenue_per_engaged_hour"
            ),
        )
    )
