"""Forecast errors, bias diagnosis, and the product of two models as expected revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.columns import first_label, tally
from tidegrid.operators.history import hourly_window
from tidegrid.operators.joins import period_compare
from tidegrid.operators.profile import quantile_bins
from tidegrid.operators.reshape import arg_extreme, entity_columns, top_per_group


def model_rows(df: DataFrame, full_history: str, artefact: Column | None = None) -> DataFrame:
    """Rows a model may use: a full history, and no clock artefact."""
    usable = F.col(full_history)
    return df.where(usable & ~artefact) if artefact is not None else df.where(usable)


def error_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """``n``, ``rmse`` and ``mae`` over the rows where both values are present."""
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.groupBy(*by).agg(
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def naive_benchmark(df: DataFrame, pairs: Mapping[str, tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Seasonal-naive errors of several targets, all from one pass over the test rows."""
    measures, rows = [], []
    for i, (target, (actual, naive)) in enumerate(pairs.items()):
        error = F.col(actual).cast("double") - F.col(naive).cast("double")
        measures += [
            F.count(error).alias(f"n{i}"),
            F.sqrt(F.avg(error * error)).alias(f"r{i}"),
            F.avg(F.abs(error)).alias(f"a{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(target).alias("target"),
                F.col(f"n{i}").alias("n"),
                F.col(f"r{i}").alias("rmse"),
                F.col(f"a{i}").alias("mae"),
            )
        )
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*rows)))


def comparison(df: DataFrame, rows: Sequence[tuple[str, str, str, str, Column | None]]) -> DataFrame:
    """``(target, model, n, rmse, mae)`` per ``(target, model, actual, predicted, support)``.

    Every figure comes from the same pass, and ``n`` is beside it because rows are comparable
    only at equal n.
    """
    measures, out = [], []
    for i, (target, model, actual, predicted, support) in enumerate(rows):
        error = F.col(actual).cast("double") - F.col(predicted).cast("double")
        if support is not None:
            error = F.when(support, error)
        measures += [
            F.count(error).alias(f"n{i}"),
            F.sqrt(F.avg(error * error)).alias(f"r{i}"),
            F.avg(F.abs(error)).alias(f"a{i}"),
        ]
        out.append(
            F.struct(
                F.lit(target).alias("target"),
                F.lit(model).alias("model"),
                F.col(f"n{i}").alias("n"),
                F.col(f"r{i}").alias("rmse"),
                F.col(f"a{i}").alias("mae"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*out)))


def score_common(df: DataFrame, actual: str, predicted: str, benchmark: str) -> DataFrame:
    """Errors on the benchmark's support, on the full support, and on the rows between them.

    The error on the dropped rows is recovered from the two sums of squares.
    """
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    naive = F.col(actual).cast("double") - F.col(benchmark).cast("double")
    common = F.when(naive.isNotNull(), error)
    row = df.agg(
        F.count(naive).alias("n_benchmark"),
        F.sqrt(F.avg(naive * naive)).alias("benchmark_rmse"),
        F.count(common).alias("n_common"),
        F.sqrt(F.avg(common * common)).alias("common_rmse"),
        F.count(error).alias("n_full"),
        F.sqrt(F.avg(error * error)).alias("full_rmse"),
    )
    dropped = F.col("n_full") - F.col("n_common")
    squares = F.col("n_full") * F.pow("full_rmse", F.lit(2.0)) - F.col("n_common") * F.pow(
        "common_rmse", F.lit(2.0)
    )
    return row.select(
        "*",
        dropped.alias("n_dropped"),
        F.when(dropped > 0, F.sqrt(F.greatest(squares, F.lit(0.0)) / dropped)).alias("dropped_rmse"),
        (F.lit(100.0) * (1 - F.try_divide(F.col("common_rmse"), F.col("benchmark_rmse")))).alias(
            "improvement_pct"
        ),
    )


def poisson_deviance_terms(actual: Column, fitted: Column) -> Column:
    """Unit Poisson deviance; a zero count contributes its fitted mean only."""
    y = actual.cast("double")
    ratio = F.when(y > 0, y * F.ln(y / fitted)).otherwise(F.lit(0.0))
    return F.lit(2.0) * (ratio - (y - fitted))


def poisson_deviance(
    df: DataFrame, actual: str, fitted: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Mean Poisson deviance per model over rows with a positive fitted mean."""
    measures = []
    for model, column in fitted.items():
        mu = F.col(column).cast("double")
        measures.append(F.avg(F.when(mu > 0, poisson_deviance_terms(F.col(actual), mu))).alias(model))
    return df.groupBy(*by).agg(*measures)


def winner_per_loss(losses: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Model with the smallest value of each loss, and whether the losses agree."""
    row = losses.agg(
        *[F.min_by(model, F.struct(F.col(c), F.col(model))).alias(f"{c}_winner") for c in columns]
    )
    first = F.col(f"{columns[0]}_winner")
    agree = reduce(lambda a, c: a & (F.col(f"{c}_winner") == first), columns[1:], F.lit(True))
    return row.select("*", agree.alias("losses_agree"))


def residual_covariance(
    df: DataFrame, count: tuple[str, str], value: tuple[str, str], observed: str
) -> DataFrame:
    """Mean product of the two residuals where both exist, against level and shortfall.

    ``E[n v] - E[n] E[v]`` is what multiplying two conditional means leaves out.
    """
    (n, n_hat), (v, v_hat) = count, value
    cn = F.col(n).cast("double") - F.col(n_hat)
    cv = F.col(v).cast("double") - F.col(v_hat)
    row = df.agg(
        F.count(cn * cv).alias("n_defined"),
        F.avg(cn * cv).alias("covariance"),
        F.avg(observed).alias("mean_observed"),
        ((F.sum(observed) - F.sum(F.col(n_hat) * F.col(v_hat))) / F.count("*")).alias(
            "shortfall_per_hour"
        ),
    )
    return row.select(
        "*",
        F.try_divide(100.0 * F.col("covariance"), F.col("mean_observed")).alias("share_of_level_pct"),
        F.try_divide(100.0 * F.col("covariance"), F.col("shortfall_per_hour")).alias(
            "share_of_shortfall_pct"
        ),
    )


def residual_report(df: DataFrame, residual: str, by: Sequence[str]) -> DataFrame:
    """Mean and mean absolute residual per group."""
    return df.groupBy(*by).agg(
        F.avg(residual).alias("mean_error"),
        F.avg(F.abs(F.col(residual))).alias("mean_abs_error"),
        F.count(residual).alias("n"),
    )


def sign_share(report: DataFrame) -> DataFrame:
    """Share of cells whose mean residual is positive."""
    return report.agg(
        F.count("*").alias("cells"),
        tally(F.col("mean_error") > 0).alias("positive_cells"),
        F.avg(F.when(F.col("mean_error") > 0, 1.0).otherwise(0.0)).alias("share_positive"),
    )


def worst_rows(report: DataFrame, value: Column, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` groups with the largest value, ties by key, without a global sort."""
    return report.orderBy(value.desc_nulls_last(), *keys).limit(k)


def autocorrelation(
    df: DataFrame,
    residual: Column,
    entity: Sequence[str],
    keep: Column | None = None,
    lag: int = 1,
    date: str = "date",
    hour: str = "hour",
) -> DataFrame:
    """Correlation of the residual with its own lag per entity, on wall-clock hours.

    The lag is taken on the complete grid and rows are filtered afterwards, so removing an
    artefact hour never makes its two neighbours look adjacent.
    """
    value = residual if keep is None else F.when(keep, residual)
    rows = df.select(*entity, date, hour, value.alias("_r"))
    rows = rows.select("*", F.lag("_r", lag).over(hourly_window(entity, date, hour)).alias("_p"))
    return rows.groupBy(*entity).agg(
        F.corr("_r", "_p").alias("autocorrelation"),
        tally(F.col("_r").isNotNull() & F.col("_p").isNotNull()).alias("pairs"),
    )


def level_shift(
    df: DataFrame, value: str, entity: Sequence[str], split: str, calendar: Sequence[str]
) -> DataFrame:
    """Level per entity in train and test on the calendar cells the test period covers."""
    covered = df.where(F.col(split) == "test").select(*calendar).distinct()
    same = df.join(covered, on=list(calendar), how="left_semi")
    means = same.groupBy(*entity).agg(
        F.avg(F.when(F.col(split) == "train", F.col(value))).alias("train_level"),
        F.avg(F.when(F.col(split) == "test", F.col(value))).alias("test_level"),
    )
    change = F.lit(100.0) * (F.try_divide(F.col("test_level"), F.col("train_level")) - 1)
    return means.select("*", change.alias("change_pct"))


def bias_by_bin(df: DataFrame, predicted: str, actual: str, residual: str, bins: int = 10) -> DataFrame:
    """Mean prediction, observation and residual per equal-count bin of the prediction."""
    return quantile_bins(df, predicted, bins, "bin").where(F.col("bin").isNotNull()).groupBy("bin").agg(
        F.avg(predicted).alias("mean_predicted"),
        F.avg(actual).alias("mean_observed"),
        F.avg(residual).alias("mean_error"),
        F.count("*").alias("n"),
    )


def _line(df: DataFrame, y: Column, x: Column) -> DataFrame:
    """Least squares of ``y`` on ``x`` from one aggregate: n, means, slope and its standard error, range of x."""
    both = df.select(y.cast("double").alias("_y"), x.cast("double").alias("_x")).where(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    row = both.agg(
        F.count("*").alias("n"),
        F.avg("_y").alias("mean"),
        F.avg(F.col("_y") * F.col("_y")).alias("square"),
        F.var_pop("_y").alias("_vy"),
        F.avg("_x").alias("_mx"),
        F.var_pop("_x").alias("_vx"),
        F.covar_pop("_y", "_x").alias("_c"),
        F.min("_x").alias("_x0"),
        F.max("_x").alias("_x1"),
    ).withColumn("slope", F.try_divide("_c", "_vx"))
    left = F.greatest(F.col("_vy") - F.col("slope") * F.col("_c"), F.lit(0.0))
    return row.withColumn("slope_se", F.sqrt(F.try_divide(left, (F.col("n") - 2) * F.col("_vx"))))


def bias_shape(df: DataFrame, residual: str, predicted: str, least_share: float = 0.01) -> DataFrame:
    """How much of the squared error a constant and a trend over the predicted level account for.

    The mean square of the residual parts exactly into that of its mean, that of its line over the
    prediction, and the rest. The shape is the larger of the first two, or ``none`` where neither
    reaches ``least_share``; the slope comes with its standard error.
    """
    row = _line(df, F.col(residual), F.col(predicted)).select(
        "n",
        F.col("mean").alias("mean_error"),
        "slope",
        "slope_se",
        F.try_divide(F.col("mean") * F.col("mean"), F.col("square")).alias("level_share"),
        F.coalesce(F.try_divide(F.col("slope") * F.col("_c"), F.col("square")), F.lit(0.0)).alias("slope_share"),
    )
    shape = first_label(
        [
            ("none", F.greatest("level_share", "slope_share") < least_share),
            ("level", F.col("level_share") >= F.col("slope_share")),
        ],
        "slope",
    )
    return row.select("*", shape.alias("shape"))


def profile_shape(
    profile: DataFrame, mean_bias: Column, level_change: Column, monotone_above: float = 0.8, even_below: float = 0.5
) -> DataFrame:
    """Name the shape of a bias from its profile over the bins of the prediction.

    A rank trend of the bins' errors beyond ``monotone_above`` is an attenuation; scatter of less
    than ``even_below`` of the mean bias is a level shift; anything else is concentrated, with the
    bin where it peaks. The change of the level comes with whether it has the sign of the bias.
    """
    every = W.partitionBy(F.lit(1))  # one row per bin, whatever the number of rows behind it

    def average_rank(column: str) -> Column:
        return F.rank().over(every.orderBy(column)) + (F.count("*").over(W.partitionBy(column)) - 1) / F.lit(2.0)

    ranked = profile.select("*", average_rank("mean_error").alias("_re"), average_rank("mean_predicted").alias("_rp"))
    row = ranked.agg(
        F.stddev_samp("mean_error").alias("bin_scatter"),
        F.min_by("bin", F.struct(-F.abs("mean_error"), "bin")).alias("peak_bin"),
        F.min_by("mean_error", "bin").alias("quietest_error"),
        F.max_by("mean_error", "bin").alias("busiest_error"),
        F.corr("_re", "_rp").alias("trend"),
    ).select("*", mean_bias.alias("mean_bias"), level_change.alias("level_change_pct"))
    shape = first_label(
        [
            ("attenuation", F.abs("trend") > monotone_above),
            ("level shift", F.col("bin_scatter") < F.lit(even_below) * F.abs("mean_bias")),
        ],
        "concentrated",
    )
    return row.select(
        "*",
        shape.alias("profile_shape"),
        ((F.col("level_change_pct") > 0) == (F.col("mean_bias") > 0)).alias("level_explains_sign"),
    )


def horizon_decay(df: DataFrame, residual: str, period: Column, fades_to: float = 0.5) -> DataFrame:
    """The line of the residual over the days of the horizon, its ends, and whether the bias fades.

    It fades where the end of the line is within ``fades_to`` of its start, in size.
    """
    line = _line(df, F.col(residual), F.unix_date(period.cast("date")))
    ends = [(F.col("mean") + F.col("slope") * (F.col(x) - F.col("_mx"))).alias(name) for x, name in (("_x0", "at_start"), ("_x1", "at_end"))]
    row = line.select("n", "slope", "slope_se", *ends)
    return row.select("*", (F.abs("at_end") <= F.lit(fades_to) * F.abs("at_start")).alias("fades"))


def attribute_bias(
    residual_cells: DataFrame,
    train_cells: DataFrame,
    test_cells: DataFrame,
    on: Sequence[str],
    driver: str,
    ratio: str,
    support: str,
    min_support: float,
) -> DataFrame:
    """Residual per cell beside the change of the driver and of the conversion ratio.

    The conversion change is null in cells with too thin a base in either period.
    """
    moved = period_compare(train_cells, test_cells, on, driver, ("train", "test")).select(
        *on, F.col("change").alias("driver_change")
    )
    converted = period_compare(
        train_cells, test_cells, on, ratio, ("train", "test"), support, min_support
    ).select(
        *on,
        F.when(F.col("supported"), F.col("change")).alias("conversion_change"),
        "supported",
    )
    return residual_cells.join(moved, on=list(on), how="left").join(converted, on=list(on), how="left")


def attribution_summary(cells: DataFrame, error: str = "mean_error") -> DataFrame:
    """Correlation of the residual with each candidate, and the cells behind it."""
    return cells.agg(
        F.corr(error, "driver_change").alias("driver_correlation"),
        F.corr(error, "conversion_change").alias("conversion_correlation"),
        tally(F.col("supported")).alias("supported_cells"),
        tally(~F.coalesce("supported", F.lit(False))).alias("thin_cells"),
    )


def combine_revenue(
    df: DataFrame, count: str, value: str, naive_count: str, naive_value: str
) -> DataFrame:
    """Expected revenue, and the naive product that is zero where last week was empty."""
    naive = F.when(F.col(naive_count) == 0, F.lit(0.0)).otherwise(
        F.col(naive_count) * F.col(naive_value)
    )
    return df.select(
        "*",
        (F.col(count) * F.col(value)).alias("pred_revenue"),
        naive.alias("naive_revenue"),
    )


def surface(df: DataFrame, by: Sequence[str], means: Mapping[str, str]) -> DataFrame:
    """Mean of each prediction per cell (entity, weekday, hour)."""
    return df.groupBy(*by).agg(*[F.avg(c).alias(n) for n, c in means.items()])


def crossover(
    cells: DataFrame, keys: Sequence[str], entity: str, pair: tuple[str, str], value: str
) -> DataFrame:
    """Cells where the second entity of the pair is ahead of the first, with the advantage."""
    first, second = pair
    wide = entity_columns(cells, keys, entity, [first, second], value)
    return wide.where(F.col(second) > F.col(first)).select(
        *keys, first, second, (F.col(second) - F.col(first)).alias("advantage")
    )


def best_hours(cells: DataFrame, entity: str, hour: str, value: str, k: int) -> DataFrame:
    """Best ``k`` hours per entity, ties by hour."""
    return top_per_group(cells, [entity], [F.col(value).desc_nulls_last(), F.col(hour)], k)


def peak_and_trough(cells: DataFrame, entity: str, hour: str, value: str) -> DataFrame:
    """Hour and level of the peak and the trough per entity, and their ratio."""
    high = arg_extreme(cells, [entity], value, [hour], True).withColumnsRenamed(
        {hour: "peak_hour", value: "peak"}
    )
    low = arg_extreme(cells, [entity], value, [hour], False).withColumnsRenamed(
        {hour: "trough_hour", value: "trough"}
    )
    return high.join(low, on=entity).select(
        "*", (F.col("peak") / F.greatest(F.col("trough"), F.lit(0.01))).alias("peak_over_trough")
    )
