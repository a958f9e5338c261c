"""Training-only imputation, scaling and levels, and the dummy-coded design of the GLM.

What is fitted is a handful of numbers per column (a median, a mean, a level list); only these
reach the driver. Rows stay distributed.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.contracts import null_counts, require_empty
from tidegrid.operators.order_stats import bracketed_counts, exact_quantiles


@dataclass(frozen=True)
class Fill:
    """How each documented null family is resolved."""

    zeros: tuple[str, ...] = ()
    medians: Mapping[str, float] = field(default_factory=dict)
    booleans: tuple[str, ...] = ()


def train_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, median)`` of the training rows, exact and interpolated."""
    counts = bracketed_counts(train, {c: F.col(c) for c in columns}, [0.5])
    medians = exact_quantiles(counts, ["metric"], [0.5], interpolate=True, fixed_groups=True)
    return medians.select(F.col("metric").alias("column_name"), F.col("quantile").alias("median"))


def fit_fill(
    train: DataFrame, zeros: Sequence[str], medians: Sequence[str], booleans: Sequence[str]
) -> Fill:
    """Learn the fill from training rows only; one number per column is collected."""
    learned = {}
    if medians:
        learned = {r["column_name"]: r["median"] for r in train_medians(train, medians).collect()}
    return Fill(tuple(zeros), learned, tuple(booleans))


def apply_fill(df: DataFrame, fill: Fill) -> DataFrame:
    """Resolve the documented null families in one projection."""

    def resolved(c: str) -> Column:
        if c in fill.zeros:
            return F.coalesce(F.col(c), F.lit(0.0)).alias(c)
        if c in fill.medians:
            return F.coalesce(F.col(c), F.lit(fill.medians[c])).alias(c)
        if c in fill.booleans:
            return F.coalesce(F.col(c), F.lit(False)).alias(c)
        return F.col(c)

    return df.select(*[resolved(c) for c in df.columns])


def require_complete(df: DataFrame, columns: Sequence[str]) -> None:
    """Fail when a feature still holds a null: an undocumented family got through."""
    left = null_counts(df.select(*columns)).where(F.col("nulls") > 0)
    require_empty(left, "undocumented nulls survive imputation")


def scale_statistics(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, centre, spread)``: mean and population deviation of training rows."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"m_{c}").alias("centre"),
                        F.col(f"s_{c}").alias("spread"),
                    )
                    for c in columns
                ]
            )
        )
    )


def fit_scale(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    return {
        r["column_name"]: (r["centre"], r["spread"])
        for r in scale_statistics(train, columns).collect()
    }


def apply_scale(df: DataFrame, statistics: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale; a column constant in training is centred and left unscaled."""

    def scaled(c: str) -> Column:
        if c not in statistics:
            return F.col(c)
        centre, spread = statistics[c]
        return ((F.col(c) - F.lit(centre)) / F.lit(spread if spread > 0 else 1.0)).alias(c)

    return df.select(*[scaled(c) for c in df.columns])


def fit_levels(train: DataFrame, columns: Sequence[str]):
    """Freeze categorical levels on training rows; an unseen level fails at transform."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="error",
        stringOrderType="alphabetAsc",
    )
    return indexer.fit(train.select(*[F.col(c).cast("string").alias(c) for c in columns]))


def apply_levels(model, df: DataFrame) -> DataFrame:
    columns = model.getInputCols()
    text = df.select(
        *[c for c in df.columns if c not in columns],
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    return model.transform(text)


def unseen_levels(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, level)`` present in ``df`` and absent from training."""

    def levels(frame: DataFrame) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level"))
                for c in columns
            ]
        )
        return frame.select(F.inline(pairs)).where(F.col("level").isNotNull()).distinct()

    return levels(df).join(levels(train), on=["column_name", "level"], how="left_anti")


@dataclass(frozen=True)
class Design:
    """Named design columns over a frame; ``intercept`` is left to the estimator."""

    terms: tuple[tuple[str, Column], ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.terms]

    def without(self, names: Collection[str]) -> Design:
        return Design(tuple((name, c) for name, c in self.terms if name not in names))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """The frame with the design columns assembled into one vector."""
        spare = {name: f"_x{i}" for i, (name, _) in enumerate(self.terms)}
        wide = df.select(
            *df.columns, *[c.cast("double").alias(spare[name]) for name, c in self.terms]
        )
        assembled = VectorAssembler(inputCols=list(spare.values()), outputCol=features).transform(wide)
        return assembled.drop(*spare.values())


def levels_of(train: DataFrame, column: str) -> list:
    """Sorted levels of a bounded categorical (hour, weekday, entity) in training."""
    return sorted(r[0] for r in train.select(column).distinct().collect() if r[0] is not None)


def dummies(column: str, levels: Sequence) -> list[tuple[str, Column]]:
    """Indicator per level but the first, which is the reference."""
    return [(f"{column}[{v}]", (F.col(column) == F.lit(v)).cast("double")) for v in levels[1:]]


def interaction(
    a: Sequence[tuple[str, Column]], b: Sequence[tuple[str, Column]]
) -> list[tuple[str, Column]]:
    """Products of two sets of reduced dummies."""
    return [(f"{n}:{m}", x * y) for m, y in b for n, x in a]


def glm_design(
    levels: Mapping[str, Sequence],
    interact: tuple[str, str],
    categorical: Sequence[str],
    indicators: Sequence[str],
    continuous: Sequence[str],
) -> Design:
    """Two interacted factors, further factors as dummies, indicators, and scaled terms.

    Reduced dummies and their products keep the design of full rank; a factor with a single
    training level contributes nothing.
    """
    a, b = interact
    da, db = dummies(a, levels[a]), dummies(b, levels[b])
    terms = [*da, *db, *interaction(da, db)]
    for c in categorical:
        terms += dummies(c, levels[c])
    terms += [(c, F.col(c).cast("double")) for c in indicators]
    terms += [(c, F.col(c).cast("double")) for c in continuous]
    return Design(tuple(terms))
