"""Distributions, fences, spectra, dispersion and ranks over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.columns import bin_floor, tally
from tidegrid.operators.order_stats import (
    average_rank,
    bracketed_counts,
    exact_quantiles,
    quantile_columns,
    value_counts,
)

# The percentiles reported and their labels.
PERCENTILES = {
    "p1": 0.01,
    "p5": 0.05,
    "p25": 0.25,
    "p50": 0.5,
    "p75": 0.75,
    "p95": 0.95,
    "p99": 0.99,
    "p99_9": 0.999,
}


def _moments(
    df: DataFrame, segments: Mapping[str, Column], metrics: Mapping[str, Column], extra
) -> DataFrame:
    """``(segment, metric, n, mean, sd, skew, max, ...)`` with segments as masks, in one pass; NaN is no value."""
    measures, rows = [], []
    for i, (segment, mask) in enumerate(segments.items()):
        for j, (metric, value) in enumerate(metrics.items()):
            masked = F.when(mask & ~F.isnan(value.cast("double")), value)
            cell = {
                "n": F.count(masked),
                "mean": F.avg(masked),
                "sd": F.stddev(masked),
                "skew": F.skewness(masked),
                "max": F.max(masked).cast("double"),
                **extra(masked),
            }
            measures += [c.alias(f"m{i}_{j}_{name}") for name, c in cell.items()]
            rows.append(
                F.struct(
                    F.lit(segment).alias("segment"),
                    F.lit(metric).alias("metric"),
                    *[F.col(f"m{i}_{j}_{name}").alias(name) for name in cell],
                )
            )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def distribution_summary(
    df: DataFrame,
    segments: Mapping[str, Column],
    metrics: Mapping[str, Column],
    percentiles: Mapping[str, float] = PERCENTILES,
    accuracy: int | None = None,
) -> DataFrame:
    """Moments and percentiles of every metric in every segment, one row per pair.

    Moments come from a single pass with fixed-size state. Percentiles are exact by default, from
    counts of the values that a sketch brackets; with ``accuracy`` set they are the sketch itself.
    """
    if accuracy is not None:
        probs = list(percentiles.values())
        wide = _moments(
            df,
            segments,
            metrics,
            lambda x: {"pct": F.percentile_approx(x.cast("double"), probs, accuracy)},
        )
        return wide.select(
            *[c for c in wide.columns if c != "pct"],
            *[F.col("pct")[i].alias(name) for i, name in enumerate(percentiles)],
        )
    moments = _moments(df, segments, metrics, lambda x: {})
    probs = sorted(set(percentiles.values()))
    counts = bracketed_counts(df, metrics, probs, segments)
    quantiles = exact_quantiles(counts, ["segment", "metric"], probs, fixed_groups=True)
    wide = quantile_columns(quantiles, ["segment", "metric"], percentiles)
    return moments.join(wide, on=["segment", "metric"], how="left")


def distribution_flags(summary: DataFrame, top: str = "p99_9", dominated_above: float = 0.10) -> DataFrame:
    """Share of variance owed to the largest record, and warnings derived from it."""
    deviation = F.pow(F.col("max") - F.col("mean"), F.lit(2.0))
    owed = F.try_divide(deviation, F.col("n") * F.pow("sd", F.lit(2.0)))
    return summary.select(
        "*",
        owed.alias("max_share_of_variance"),
        F.coalesce(F.abs(F.col(top) - F.col("max")) <= 1e-8 + 1e-5 * F.abs("max"), F.lit(False)).alias(
            "tail_unresolved"
        ),
        F.coalesce(owed > dominated_above, F.lit(False)).alias("variance_dominated"),
    )


def fence_bounds(quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """Upper Tukey fence from ``p25`` and ``p75``."""
    return quartiles.select(
        "*", (F.col("p75") + F.lit(k) * (F.col("p75") - F.col("p25"))).alias("upper_fence")
    )


def tukey_fences(
    df: DataFrame, segments: Mapping[str, Column], metrics: Mapping[str, Column], k: float = 1.5
) -> DataFrame:
    """Upper fence and the rows beyond it, per segment and metric.

    Quartiles come from bracketed counts. The fences are one row per listed segment and metric, so
    they are broadcast to the rows, which are counted where they are.
    """
    by = ["segment", "metric"]
    counts = bracketed_counts(df, metrics, [0.25, 0.5, 0.75], segments)
    quartiles = quantile_columns(
        exact_quantiles(counts, by, [0.25, 0.5, 0.75], fixed_groups=True), by, {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    )
    fences = fence_bounds(quartiles, k)
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("segment"), F.lit(m).alias("metric"), F.when(mask, column.cast("double")).alias("value"))
            for s, mask in segments.items()
            for m, column in metrics.items()
        ]
    )
    flat = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    beyond = flat.join(F.broadcast(fences.select(*by, "upper_fence")), on=by).groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > F.col("upper_fence")).alias("n_above_fence")
    )
    return fences.join(F.broadcast(beyond), on=by).select(
        "*", (100.0 * F.col("n_above_fence") / F.col("n")).alias("pct_above_fence")
    )


def upper_fence(df: DataFrame, value: Column, k: float = 1.5) -> Column:
    """The fence of one metric as a scalar subquery, usable in a filter on the same table."""
    counts = bracketed_counts(df, {"value": value}, [0.25, 0.75])
    quartiles = quantile_columns(
        exact_quantiles(counts, ["metric"], [0.25, 0.75], fixed_groups=True), ["metric"], {"p25": 0.25, "p75": 0.75}
    )
    return fence_bounds(quartiles, k).select("upper_fence").scalar()


def profile_extremes(
    df: DataFrame,
    beyond: Column,
    key: str,
    dimension: DataFrame,
    by: Sequence[str],
    means: Mapping[str, str],
) -> DataFrame:
    """Profile the rows beyond a fence by attributes, with their share of all extremes.

    Extremes are summed per dimension key before the join, and sums regroup to exact means.
    """
    local = [c for c in by if c in df.columns]
    reduced = (
        df.where(beyond)
        .groupBy(*dict.fromkeys([key, *local]))
        .agg(F.count("*").alias("row_count"), *[F.sum(c).alias(c) for c in means.values()])
    )
    cells = reduced.join(dimension, on=key, how="left").groupBy(*by).agg(
        F.sum("row_count").alias("row_count"), *[F.sum(c).alias(c) for c in means.values()]
    )
    total = cells.agg(F.sum("row_count")).scalar()
    return cells.select(
        *by,
        "row_count",
        *[(F.col(c) / F.col("row_count")).alias(name) for name, c in means.items()],
        total.alias("_all"),
    ).select(
        *by, "row_count", *means, (100.0 * F.col("row_count") / F.col("_all")).alias("pct_of_extremes")
    )


def value_spectrum(
    df: DataFrame, value: Column, segments: Mapping[str, Column], name: str = "value", digits: int = 2
) -> DataFrame:
    """Rows per distinct rounded value, with a count per segment beside the total."""
    return df.groupBy(F.round(value, digits).alias(name)).agg(
        F.count("*").alias("row_count"), *[tally(m).alias(s) for s, m in segments.items()]
    )


def modes(spectrum: DataFrame, segments: Sequence[str], name: str = "value") -> DataFrame:
    """Most common value per segment, smallest on a tie, and its share of that segment."""
    best = {
        s: F.max_by(
            F.struct(F.col(name).alias("mode"), F.col(s).alias("mode_rows")),
            F.struct(F.col(s), -F.col(name)),
        )
        for s in segments
    }
    wide = spectrum.agg(
        *[c.alias(f"b_{s}") for s, c in best.items()],
        *[F.sum(s).alias(f"t_{s}") for s in segments],
    )
    rows = [
        F.struct(
            F.lit(s).alias("segment"),
            F.col(f"b_{s}.mode").alias("mode"),
            F.col(f"b_{s}.mode_rows").alias("mode_rows"),
            F.col(f"t_{s}").alias("segment_rows"),
            F.try_divide(100.0 * F.col(f"b_{s}.mode_rows"), F.col(f"t_{s}").cast("double")).alias(
                "mode_pct"
            ),
        )
        for s in segments
    ]
    return wide.select(F.inline(F.array(*rows)))


def mass_point(spectrum: DataFrame, point: float, segments: Sequence[str], name: str = "value") -> DataFrame:
    """Rows sitting on one given value per segment, and their share of the segment."""
    hit = F.abs(F.col(name) - F.lit(point)) < 1e-8
    wide = spectrum.agg(
        *[F.sum(F.when(hit, F.col(s)).otherwise(0)).alias(f"h_{s}") for s in segments],
        *[F.sum(s).alias(f"t_{s}") for s in segments],
    )
    rows = [
        F.struct(
            F.lit(s).alias("segment"),
            F.col(f"h_{s}").alias("rows_at_point"),
            F.try_divide(100.0 * F.col(f"h_{s}"), F.col(f"t_{s}").cast("double")).alias("pct_at_point"),
        )
        for s in segments
    ]
    return wide.select(F.inline(F.array(*rows)))


def binned_spectrum(
    spectrum: DataFrame, width: float, upper: float, columns: Sequence[str], name: str = "value"
) -> DataFrame:
    """Spectrum in fixed-width bins up to a limit, as a share of each column's full total.

    The limit is a mask and not a filter, so the bins and the totals share one spectrum.
    """
    totals = spectrum.agg(F.struct(*[F.sum(c).alias(c) for c in columns])).scalar()
    shown = F.col(name) <= upper
    bins = (
        spectrum.groupBy(bin_floor(name, width).alias("bin"))
        .agg(tally(shown).alias("_shown"), *[F.sum(F.when(shown, F.col(c))).alias(c) for c in columns])
        .where(F.col("_shown") > 0)
        .select("*", totals.alias("_t"))
    )
    return bins.select(
        "bin",
        *columns,
        *[
            F.try_divide(100.0 * F.col(c), F.col(f"_t.{c}").cast("double")).alias(f"{c}_pct")
            for c in columns
        ],
    )


def dispersion(df: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    """Variance over mean of a count within each cell."""
    cells = df.groupBy(*cell).agg(
        F.avg(value).alias("mean"), F.var_samp(value).alias("variance"), F.count("*").alias("days")
    )
    return cells.select(
        "*", F.when(F.col("mean") > 0, F.col("variance") / F.col("mean")).alias("dispersion")
    )


def dispersion_summary(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Median, smallest and largest dispersion per group, and the cells above one."""
    counts = value_counts(cells, {"dispersion": F.col("dispersion")}, by=by)
    median = quantile_columns(
        exact_quantiles(counts, [*by, "metric"], [0.5], interpolate=True),
        by,
        {"median_dispersion": 0.5},
    )
    rest = cells.groupBy(*by).agg(
        F.min("dispersion").alias("min_dispersion"),
        F.max("dispersion").alias("max_dispersion"),
        tally(F.col("dispersion") > 1).alias("overdispersed_cells"),
        F.count("*").alias("cells"),
    )
    return rest.join(median, on=list(by), how="left")


def percent_rank_average(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Join back the percent rank within the group, ties sharing their average rank."""
    counts = value_counts(df, {"v": F.col(value)}, by=by)
    ranks = average_rank(counts, [*by, "metric"]).select(
        *by, F.col("value").alias("_v"), F.col("pct_rank").alias(name)
    )
    return df.select("*", F.col(value).cast("double").alias("_v")).join(
        ranks, on=[*by, "_v"], how="left"
    ).select(*df.columns, name)


def rank_gap(df: DataFrame, high: str, low: str, by: Sequence[str]) -> DataFrame:
    """Percent ranks of two columns within the group, and their difference."""
    ranked = percent_rank_average(df, low, by, f"{low}_rank")
    ranked = percent_rank_average(ranked, high, by, f"{high}_rank")
    return ranked.select("*", (F.col(f"{high}_rank") - F.col(f"{low}_rank")).alias("rank_gap"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Rank correlation per group over rows where both columns are present."""
    usable = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = percent_rank_average(usable, x, by, "_rx")
    ranked = percent_rank_average(ranked, y, by, "_ry")
    return ranked.groupBy(*by).agg(
        F.corr("_rx", "_ry").alias("spearman"), F.count("*").alias("n")
    )


def quantile_bins(df: DataFrame, value: str, bins: int, name: str = "bin") -> DataFrame:
    """Equal-count bins of a column, 1 to ``bins``; edges that coincide are merged.

    The edges are one array in a scalar subquery; a row's bin is the number of inner edges
    below its value.
    """
    probs = [round(i / bins, 7) for i in range(bins + 1)]
    counts = bracketed_counts(df, {"v": F.col(value)}, probs)
    edges = exact_quantiles(counts, ["metric"], probs, interpolate=True, fixed_groups=True)
    inner = edges.agg(F.array_sort(F.collect_set("quantile"))).scalar()
    return (
        df.select("*", inner.alias("_edges"))
        .select(
            *df.columns,
            F.when(
                F.col(value).isNotNull(),
                F.greatest(
                    F.size(F.filter("_edges", lambda e: e < F.col(value).cast("double"))), F.lit(1)
                ),
            ).alias(name),
        )
    )
