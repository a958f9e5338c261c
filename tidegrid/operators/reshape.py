"""Grids to matrices and back, top-k per group, picks and arg-max rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def weekday_hour_matrix(
    df: DataFrame, value: str, by: Sequence[str], weekday: str = "day_of_week", hour: str = "hour"
) -> DataFrame:
    """Mean of a column as a 7 x 24 matrix per group: a row per weekday, ``h00`` ... ``h23``.

    Every weekday of every group is present, so a missing cell is null and shifts nothing.
    """
    cells = df.groupBy(*by, weekday).agg(
        *[F.avg(F.when(F.col(hour) == h, F.col(value))).alias(f"h{h:02d}") for h in range(24)]
    )
    days = F.explode(F.sequence(F.lit(1), F.lit(7))).alias(weekday)
    frame = df.select(*by).distinct().select(*by, days)
    return frame.join(cells, on=[*by, weekday], how="left")


def matrix_to_long(matrix: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Unpivot a weekday-hour matrix to ``(keys..., hour, value)``."""
    long = matrix.unpivot(list(keys), [f"h{h:02d}" for h in range(24)], "_h", name)
    return long.select(*keys, F.substring("_h", 2, 2).cast("int").alias("hour"), name)


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group in a total order; the caller supplies the tie-breaker.

    Spark keeps only the best ``k`` rows of a group per task before the shuffle.
    """
    window = W.partitionBy(*by).orderBy(*order)
    return df.select("*", F.row_number().over(window).alias(name)).where(F.col(name) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows in a total order, without a global sort."""
    return df.orderBy(*order).limit(k)


def union_picks(picks: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Union several top-k picks and keep each key once."""
    return reduce(DataFrame.unionByName, picks).dropDuplicates(list(key))


def arg_extreme(
    df: DataFrame, by: Sequence[str], value: str, columns: Sequence[str], largest: bool = True
) -> DataFrame:
    """Row of the largest (or smallest) value per group; ties go to the smallest columns."""
    row = F.struct(*[F.col(c) for c in [*columns, value]])
    sign = -F.col(value) if largest else F.col(value)
    best = F.min_by(row, F.struct(sign, *[F.col(c) for c in columns]))
    grouped = df.where(F.col(value).isNotNull()).groupBy(*by).agg(best.alias("_best"))
    return grouped.select(*by, *[F.col(f"_best.{c}").alias(c) for c in [*columns, value]])


def entity_columns(
    df: DataFrame, keys: Sequence[str], entity: str, entities: Sequence[str], value: str
) -> DataFrame:
    """One column per listed entity holding the mean of a value for the key."""
    return df.groupBy(*keys).agg(
        *[F.avg(F.when(F.col(entity) == e, F.col(value))).alias(e) for e in entities]
    )
