"""Joins under a contract: unique right side, unchanged rows, verified lags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of copies."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def join_audit(left: DataFrame, right: DataFrame, on: Sequence[str], label: str) -> DataFrame:
    """What a left join would do to the rows, without doing it.

    Both sides collapse to counts per key first, so the audit shuffles keys rather than rows
    and never multiplies anything out.
    """
    lefts = left.groupBy(*on).agg(F.count("*").alias("l"))
    rights = right.groupBy(*on).agg(F.count("*").alias("r"))
    return (
        lefts.join(rights, on=list(on), how="full")
        .agg(
            F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
            F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
            F.count(F.when(F.col("r") > 1, 1)).alias("duplicate_right_keys"),
            F.coalesce(
                F.sum(F.when(F.col("l").isNotNull(), F.col("l") * F.coalesce("r", F.lit(1)))),
                F.lit(0),
            ).alias("joined_rows"),
            F.coalesce(F.sum(F.when(F.col("r").isNull(), F.col("l"))), F.lit(0)).alias(
                "unmatched_left_rows"
            ),
        )
        .select(F.lit(label).alias("label"), "*")
    )


def checked_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], label: str = "join"
) -> DataFrame:
    """Left join that fails first if the right side repeats a key.

    A unique right side is what keeps the row count, so one aggregate over the right side is
    the whole check; the left side is neither counted nor scanned for it. The broadcast choice
    is Spark's, on measured size; a hot left key is split by adaptive skew handling.
    """
    if not duplicate_keys(right, on).isEmpty():
        raise ValueError(f"{label}: right side repeats keys on {list(on)}")
    return left.join(right, on=list(on), how="left")


def fanout_join(left: DataFrame, right: DataFrame, on: Sequence[str], label: str = "fan-out") -> DataFrame:
    """Join hour-level context to every entity of the hour: a checked join on part of the key."""
    return checked_left_join(left, right, on, label)


def join_dim(df: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a dimension; broadcast when its measured size is under Spark's threshold."""
    return df.join(dimension, on=list(on), how="left")


def rollup_to_dim(
    facts: DataFrame, key: str, sums: Sequence[str], path: Sequence[tuple[DataFrame, str]], by: Sequence[str]
) -> DataFrame:
    """Total facts by attributes reached through a chain of dimensions.

    Facts are summed per key before the first join, so a hot key joins as one row and every
    later join works on the reduced table.
    """
    reduced = facts.groupBy(key).agg(
        F.count("*").alias("row_count"), *[F.sum(s).alias(s) for s in sums]
    )
    for dimension, on in path:
        reduced = reduced.join(dimension, on=on, how="left")
    return reduced.groupBy(*by).agg(
        F.sum("row_count").alias("row_count"), *[F.sum(s).alias(s) for s in sums]
    )


def verify_lag(
    df: DataFrame,
    value: str,
    lag_column: str,
    days: int,
    entity: Sequence[str],
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Compare a positional lag with a date-arithmetic self join, nulls included."""
    then = df.select(
        *entity,
        F.date_add(F.col(date), days).alias(date),
        hour,
        F.col(value).alias("_then"),
        F.lit(True).alias("_present"),
    )
    both = df.select(*entity, date, hour, lag_column).join(
        then, on=[*entity, date, hour], how="left"
    )
    same = F.col(lag_column).eqNullSafe(F.col("_then"))
    return both.agg(
        F.count("*").alias("rows_checked"),
        F.count(F.when(F.col("_present"), 1)).alias("rows_with_history"),
        F.count(F.when(~same, 1)).alias("mismatches"),
    )


def peer_mean(
    df: DataFrame, keys: Sequence[str], value: str, peers: Column, name: str
) -> DataFrame:
    """Add the mean of a value over the reporting peers of the same key.

    Meant for grid tables, where a key (an hour) holds one row per site: the window partition
    is the list of sites, and the table is computed once instead of twice as a join-back would.
    """
    hour = W.partitionBy(*keys)
    reported = F.when(peers, F.col(value))
    return df.select(
        "*",
        F.avg(reported).over(hour).alias(name),
        F.count(reported).over(hour).alias(f"{name}_reporting"),
    )


def spread_context(
    df: DataFrame, keys: Sequence[str], source: Column, columns: Sequence[str], prefix: str
) -> DataFrame:
    """Give every row of a key the columns of the key's one context row, prefixed.

    The fan-out join for a context that is itself a row of the grid, as a window over the sites
    of the hour, so that the context is not computed a second time.
    """
    hour = W.partitionBy(*keys)
    return df.select(
        "*",
        *[F.max(F.when(source, F.col(c))).over(hour).alias(prefix + c) for c in columns],
    )


def period_compare(
    cells_a: DataFrame,
    cells_b: DataFrame,
    on: Sequence[str],
    value: str,
    names: tuple[str, str],
    support: str | None = None,
    min_support: float = 0.0,
) -> DataFrame:
    """Cell tables of two periods side by side, with the change and a support flag."""
    columns = [value] + ([support] if support else [])

    def side(cells: DataFrame, name: str) -> DataFrame:
        return cells.select(*on, *[F.col(c).alias(f"{name}_{c}") for c in columns])

    first, second = names
    joined = side(cells_a, first).join(side(cells_b, second), on=list(on), how="full")
    change = (F.col(f"{second}_{value}") - F.col(f"{first}_{value}")).alias("change")
    if support is None:
        return joined.select("*", change)
    supported = (F.col(f"{first}_{support}") >= min_support) & (
        F.col(f"{second}_{support}") >= min_support
    )
    return joined.select("*", change, F.coalesce(supported, F.lit(False)).alias("supported"))
