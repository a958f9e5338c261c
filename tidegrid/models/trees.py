"""Boosted trees for the value: forward tuning, refit and permutation importance."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.models.boosting import Ensemble, Setting, TreeFeatures, binned, fit_ensembles, matrix, predict
from tidegrid.sources.staging import stage

__all__ = ["TUNING_GRID", "TreeFeatures", "fit_gbt", "fit_tuned", "permutation_importance", "permute_columns", "predict_value", "tune_forward"]

# Six settings of learning rate, leaves and rounds.
TUNING_GRID = (
    {"step": 0.05, "leaves": 15, "rounds": 300},
    {"step": 0.05, "leaves": 31, "rounds": 300},
    {"step": 0.05, "leaves": 31, "rounds": 600},
    {"step": 0.10, "leaves": 15, "rounds": 200},
    {"step": 0.10, "leaves": 31, "rounds": 200},
    {"step": 0.10, "leaves": 63, "rounds": 200},
)
SEED = 42
#: Rounds of the keyed bijection, and the steps it may take to come back into its range.
FEISTEL_ROUNDS = 6
WALK = 64


def fit_gbt(df: DataFrame, features: TreeFeatures, label: str, params: Mapping[str, float], weight: str | None = None) -> Ensemble:
    """Boosted regression trees on raw features; missing values get a side of their own in every split.

    ``weight`` fits the same trees to an exposure-weighted squared error.
    """
    return fit_ensembles(df, features, label, [Setting.of(params)], weight)[0]


def predict_value(model: Ensemble, df: DataFrame, name: str) -> DataFrame:
    return predict(df, {name: (model, None)})


def tune_forward(
    df: DataFrame,
    features: TreeFeatures,
    label: str,
    date: str,
    cut: str,
    grid: Sequence[Mapping[str, float]] = TUNING_GRID,
) -> DataFrame:
    """Validation errors of every setting, fitted before the cut and scored from it on.

    One row per setting with its rank. Settings that differ in rounds only share the longest fit,
    whose first rounds are the shorter one. All are scored in one pass; only errors are collected.
    """
    cut_date = F.lit(cut).cast("date")
    inner, later = df.where(F.col(date) < cut_date), df.where((F.col(date) >= cut_date) & F.col(label).isNotNull())
    settings = [Setting.of(params) for params in grid]
    longest: dict[tuple[float, int], Setting] = {}
    for s in settings:
        kind = (s.step, s.leaves)
        if kind not in longest or longest[kind].rounds < s.rounds:
            longest[kind] = s
    models = dict(zip(longest, fit_ensembles(inner, features, label, list(longest.values())), strict=True))
    scored = predict(later, {f"_p{i}": (models[s.step, s.leaves], s.rounds) for i, s in enumerate(settings)})
    errors = [F.sqrt(F.avg((F.col(label) - F.col(f"_p{i}")) ** 2)).alias(f"e{i}") for i in range(len(settings))]
    told = scored.agg(F.count("*").alias("n"), *errors).head()
    rows = [(s.step, s.leaves, s.rounds, told["n"], told[f"e{i}"]) for i, s in enumerate(settings)]
    rows.sort(key=lambda r: (r[4] is None, r[4], r[2], r[1]))
    return df.sparkSession.createDataFrame(
        [(i, *r) for i, r in enumerate(rows, start=1)],
        "position int, step_size double, max_leaves int, rounds int, n long, valid_rmse double",
    )


def fit_tuned(df: DataFrame, tuned: DataFrame, features: TreeFeatures, label: str, weight: str | None = None) -> Ensemble:
    """The first setting of a tuning table, fitted again on all rows."""
    best = tuned.where("position = 1").head()
    return fit_gbt(df, features, label, {"step": best["step_size"], "leaves": best["max_leaves"], "rounds": best["rounds"]}, weight)


def unseen_periods(train: DataFrame, valid: DataFrame, period: str) -> DataFrame:
    """Periods of the validation fold that the fitting fold never saw."""
    return valid.select(period).distinct().join(
        train.select(period).distinct(), on=period, how="left_anti"
    )


def _hash_rank(df: DataFrame, keys: Sequence[str], seed: int, name: str, bits: int = 14) -> DataFrame:
    """Number rows 1..n in the order of a seeded hash of their key.

    The leading ``bits`` of the hash split rows into even ranges; a range is numbered on its own
    and shifted by the total of the ranges before it, so nothing is sorted in one place.
    """
    hashed = df.select("*", F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]).alias("_h"))
    part = F.shiftrightunsigned("_h", 64 - bits).cast("int")
    ranged = hashed.select("*", part.alias("_part"))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per range, whatever the size of the table.
    offsets = sizes.select(
        "_part",
        (
            F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0))
            - F.col("_size")
        ).alias("_offset"),
    )
    order = W.partitionBy("_part").orderBy("_h", *keys)
    return ranged.join(offsets, on="_part").select(
        *df.columns, (F.col("_offset") + F.row_number().over(order)).alias(name)
    )


def permuted_number(number: Column, n: int, seed: Column) -> Column:
    """A keyed bijection of 0..n-1: a Feistel network over two digits, walked until it is in range.

    The digits' bases multiply to little more than n, so a walk is out of range about once in the
    square root of n steps, and never longer than it has numbers outside.
    """
    high = max(1, int(np.ceil(np.sqrt(max(n, 1)))))
    low = max(1, -(-max(n, 1) // high))
    seed = seed.cast("long")

    def turned(x: Column) -> Column:
        first = F.struct((x / low).cast("long").alias("h"), (x % low).alias("l"))

        def half(pair: Column, k: Column) -> Column:
            up = (pair["h"] + F.pmod(F.xxhash64(pair["l"], k, seed), F.lit(high))) % high
            down = (pair["l"] + F.pmod(F.xxhash64(pair["h"], k, seed), F.lit(low))) % low
            even = k % 2 == 0
            return F.struct(F.when(even, up).otherwise(pair["h"]).alias("h"), F.when(even, pair["l"]).otherwise(down).alias("l"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), first, half, lambda pair: pair["h"] * low + pair["l"])

    walked = F.sequence(F.lit(1), F.lit(WALK))
    return F.aggregate(walked, turned(number.cast("long")), lambda x, _: F.when(x < n, x).otherwise(turned(x)))


def permute_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str], seed: int) -> DataFrame:
    """Move a block of columns together to other rows by a seeded permutation of the rows.

    Rows are numbered once in a hash order of their unique key; the block of a row goes to the row
    whose number its own is mapped to by a bijection, so every value is used exactly once.
    """
    rows = stage(_hash_rank(df, keys, seed, "_i"))
    n = rows.count()
    block = rows.select(permuted_number(F.col("_i") - 1, n, F.lit(seed)).alias("_i"), *columns)
    return rows.drop(*columns).withColumn("_i", F.col("_i") - 1).join(block, on="_i").select(*df.columns)


def permutation_importance(
    df: DataFrame,
    model: Ensemble,
    label: str,
    keys: Sequence[str],
    blocks: Mapping[str, Sequence[str]],
    repeats: int = 5,
    seed: int = SEED,
) -> DataFrame:
    """Mean and deviation of the RMSE increase when each block of columns is permuted.

    Rows are coded and numbered once. In every repeat a row meets the codes of one other row, told by
    a keyed bijection of its number, in one equi-join for all repeats; every block is then scored in
    place, and only sums of squares leave the tasks. A block of one column is the plain importance;
    collinear columns belong in one block, or each looks irrelevant because the others give it back.
    """
    features = model.bins.features
    width, names = len(features.sources), list(blocks)
    places = [[features.sources.index(c) for c in blocks[name]] for name in names]
    numbered = _hash_rank(df.where(F.col(label).isNotNull()), keys, seed, "_i")
    # the number travels as the weight: it is positive
    rows = stage(binned(numbered, model.bins, label, "_i").select("code", "label", (F.col("weight").cast("long") - 1).alias("i")))
    n = rows.count()
    each = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    other = each.select("repeat", permuted_number(F.col("i"), n, F.lit(seed) + F.col("repeat")).alias("i"), F.col("code").alias("other"))
    met = each.join(other, ["repeat", "i"]).select("code", "other", "label", "repeat")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names) + 1, repeats))
        for batch in batches:
            codes, others = matrix(batch.column(0), width), matrix(batch.column(1), width)
            y, repeat = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for b, place in enumerate([[], *places]):
                mixed = codes.copy()
                mixed[:, place] = others[:, place]
                total[b] += np.bincount(repeat, weights=(y - shared.value.predict(mixed)) ** 2, minlength=repeats)
        b, repeat = np.divmod(np.arange(total.size), repeats)
        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(repeat), pa.array(total.reshape(-1))], ["b", "repeat", "squares"])

    sums = met.mapInArrow(scored, "b long, repeat long, squares double").groupBy("b", "repeat").agg(F.sqrt(F.sum("squares") / n).alias("rmse"))
    base = sums.where("b = 0").select("repeat", F.col("rmse").alias("base"))
    named = F.element_at(F.array(*[F.lit(name) for name in names]), F.col("b").cast("int"))
    # as many rows as blocks times repeats
    runs = sums.where("b > 0").join(F.broadcast(base), "repeat").select(named.alias("block"), (F.col("rmse") - F.col("base")).alias("_d"))
    return runs.groupBy("block").agg(
        F.avg("_d").alias("rmse_increase"), F.stddev_pop("_d").alias("sd"), F.count("*").alias("repeats")
    )


def weighting_comparison(
    df: DataFrame,
    value: tuple[str, str, str],
    revenue: str,
    count: str,
) -> DataFrame:
    """Value and revenue errors of the plain and the exposure-weighted fit, count model fixed.

    ``value`` is ``(actual, plain prediction, weighted prediction)``.
    """
    actual, plain, weighted = value
    rows = []
    measures = []
    for i, (label, prediction) in enumerate((("unweighted", plain), ("weighted", weighted))):
        ev = F.col(actual) - F.col(prediction)
        er = F.col(revenue) - F.col(count) * F.col(prediction)
        measures += [F.sqrt(F.avg(ev * ev)).alias(f"v{i}"), F.sqrt(F.avg(er * er)).alias(f"r{i}")]
        rows.append(
            F.struct(
                F.lit(label).alias("weighting"),
                F.col(f"v{i}").alias("value_rmse"),
                F.col(f"r{i}").alias("revenue_rmse"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def typical_profile(
    train: DataFrame,
    cell: Sequence[str],
    continuous: Sequence[str],
    constants: Mapping[str, Column],
) -> DataFrame:
    """One row per cell: training means of the continuous terms, other terms held fixed."""
    means = train.groupBy(*cell).agg(*[F.avg(c).alias(c) for c in continuous])
    return means.select("*", *[v.alias(k) for k, v in constants.items()])
