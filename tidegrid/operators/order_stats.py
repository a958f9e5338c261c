"""Exact ranks and quantiles without gathering a group in one task.

Rows collapse to one per distinct value, values fall into order-preserving buckets, bucket
totals give offsets, and only inside a bucket are values ordered. Where the groups are listed in
code, a mergeable sketch brackets every wanted rank first, and only values inside a bracket keep
a row of their own; the quantiles stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Buckets are 1/256 of a natural-log unit wide (0.4 %) and shifted to stay on one side of zero
# over the whole range of a double.
_BUCKETS_PER_LOG_UNIT = 256
_LOG_SHIFT = 200_000
_LARGEST_LOG = 710.0
_SUB_BUCKETS = 1024
#: Accuracy of the bracketing sketch: its ranks are off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000
#: Width of a bracket on either side of a rank, in errors of the sketch.
_MARGIN = 4


def value_counts(
    df: DataFrame,
    metrics: Mapping[str, Column],
    by: Sequence[str] = (),
    segments: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows per distinct value: ``(by..., [segment,] metric, value, n)``, nulls and NaN left out.

    Segments are masks counted beside each other, so a row is read once however many segments
    hold it, and a value carried by a third of the rows is one row per map task.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), column.cast("double").alias("value"))
            for name, column in metrics.items()
        ]
    )
    present = F.col("value").isNotNull() & ~F.isnan("value")
    if segments is None:
        flat = df.select(*by, F.inline(pairs)).where(present)
        return flat.groupBy(*by, "metric", "value").agg(F.count("*").alias("n"))
    names = list(segments)
    masks = [F.coalesce(segments[s], F.lit(False)).alias(f"_in_{i}") for i, s in enumerate(names)]
    flat = df.select(*by, *masks, F.inline(pairs)).where(present)
    wide = flat.groupBy(*by, "metric", "value").agg(
        *[F.count(F.when(F.col(f"_in_{i}"), 1)).alias(s) for i, s in enumerate(names)]
    )
    rows = F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).alias("n")) for s in names])
    return wide.select(*by, "metric", "value", F.inline(rows)).where(F.col("n") > 0)


def bracketed_counts(
    df: DataFrame,
    metrics: Mapping[str, Column],
    probs: Sequence[float],
    segments: Mapping[str, Column] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``value_counts`` for the quantiles ``probs``: ``([segment,] metric, value, n)``.

    A first pass sketches where every wanted rank lies, give or take the error of the sketch. In the
    second, values inside a bracket of their segment are counted one by one, and all others between
    two brackets become one row of the largest of them: no wanted rank can be there. So about
    ``2 x _MARGIN / accuracy`` of the distinct values and one row a bracket are shuffled, and
    quantiles of the counts are those of the rows. Tables too small to be worth it keep all values.
    """
    masks = {"": F.lit(True)} if segments is None else segments
    reach = _MARGIN / accuracy
    shares = [x for p in probs for x in (max(p - reach, 0.0), min(p + reach, 1.0))]
    measures, rows = [], []
    for j, (metric, column) in enumerate(metrics.items()):
        value = column.cast("double")
        cuts = []
        for i, mask in enumerate(masks.values()):
            held = F.when(mask & ~F.isnan(value), value)
            measures += [F.percentile_approx(held, shares, accuracy).alias(f"q{i}_{j}"), F.count(held).alias(f"n{i}_{j}")]
            few = F.col(f"n{i}_{j}") * reach < 2 * _MARGIN
            for k, p in enumerate(probs):
                low, high = F.col(f"q{i}_{j}")[2 * k], F.col(f"q{i}_{j}")[2 * k + 1]
                cuts.append(
                    F.struct(
                        F.lit(i + 1).alias("segment"),
                        F.when(few | F.lit(p - reach <= 0), F.lit(float("-inf"))).otherwise(low).alias("low"),
                        F.when(few | F.lit(p + reach >= 1), F.lit(float("inf"))).otherwise(high).alias("high"),
                    )
                )
        rows.append(F.struct(F.lit(metric).alias("metric"), F.array(*cuts).alias("_cuts")))
    brackets = df.agg(*measures).select(F.inline(F.array(*rows)))

    names = list(masks)
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()])
    held = F.array(*[F.coalesce(masks[s], F.lit(False)) for s in names]).alias("_in")
    flat = df.select(held, F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    # one row a metric listed in code
    met = flat.join(F.broadcast(brackets), on="metric")
    inside = F.exists(
        "_cuts", lambda c: F.element_at("_in", c["segment"]) & (c["low"] <= F.col("value")) & (F.col("value") <= c["high"])
    )
    gap = F.size(F.filter("_cuts", lambda c: c["high"] < F.col("value")))
    told = met.withColumn("_own", F.when(inside, F.col("value"))).withColumn("_gap", F.when(F.col("_own").isNull(), gap))
    measures = []
    for i in range(len(names)):
        value = F.when(F.col("_in")[i], F.col("value"))
        measures += [F.max(value).alias(f"_v_{i}"), F.count(value).alias(f"_n_{i}")]
    wide = told.groupBy("metric", "_own", "_gap").agg(*measures)
    if segments is None:
        return wide.select("metric", F.col("_v_0").alias("value"), F.col("_n_0").alias("n"))
    each = [F.struct(F.lit(s).alias("segment"), F.col(f"_v_{i}").alias("value"), F.col(f"_n_{i}").alias("n")) for i, s in enumerate(names)]
    return wide.select("metric", F.inline(F.array(*each))).where(F.col("n") > 0)


def _bucket(value: Column) -> Column:
    """Order-preserving bucket: the logarithm is monotone, so larger values never go lower."""
    log = F.least(F.ln(F.abs(value)), F.lit(_LARGEST_LOG))
    magnitude = (F.floor(log * _BUCKETS_PER_LOG_UNIT) + _LOG_SHIFT).cast("long")
    signed = F.when(value > 0, magnitude).when(value < 0, -magnitude)
    # Never null, so no derived filter on it slips under the shared aggregate and splits it.
    return F.coalesce(signed, F.lit(0).cast("long"))


def _running(order: str, by: Sequence[str]) -> W:
    return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)


def cumulative_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``before`` (rows with a smaller value) and ``total`` to each distinct value."""
    keyed = counts.select("*", _bucket(F.col("value")).alias("_b"))
    buckets = keyed.groupBy(*by, "_b").agg(F.sum("n").alias("_m"))
    offsets = buckets.select(
        *by,
        "_b",
        (F.sum("_m").over(_running("_b", by)) - F.col("_m")).alias("_off"),
        F.sum("_m").over(W.partitionBy(*by)).alias("total"),
    )
    within = _running("value", [*by, "_b"])
    return keyed.join(offsets, on=[*by, "_b"]).select(
        *counts.columns,
        (F.col("_off") + F.sum("n").over(within) - F.col("n")).alias("before"),
        "total",
    )


def average_rank(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Average-tie rank of each distinct value, as ``rank`` and as ``pct_rank`` of the group."""
    rank = F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    return cumulative_counts(counts, by).select(
        *counts.columns, rank.alias("rank"), (rank / F.col("total")).alias("pct_rank")
    )


def _wanted_ranks(probs: Sequence[float], total: Column, interpolate: bool) -> Column:
    """Array of ``(prob, part, rank, fraction)`` for each probability, in decimal arithmetic."""
    wanted = []
    for p in probs:
        prob = F.lit(str(p)).cast("decimal(8,7)")
        if interpolate:
            position = prob * (total - 1).cast("decimal(20,0)")
            low = F.floor(position).cast("long")
            fraction = (position - low).cast("double")
            for part, rank in (("lo", low + 1), ("hi", F.least(low + 2, total))):
                wanted.append((p, part, rank, fraction))
        else:
            rank = F.greatest(F.ceil(prob * total.cast("decimal(20,0)")).cast("long"), F.lit(1))
            wanted.append((p, "lo", rank, F.lit(0.0)))
    return F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                F.lit(part).alias("part"),
                rank.cast("long").alias("rank"),
                fraction.alias("fraction"),
            )
            for p, part, rank, fraction in wanted
        ]
    )


def exact_quantiles(
    counts: DataFrame,
    by: Sequence[str],
    probs: Sequence[float],
    interpolate: bool = False,
    fixed_groups: bool = False,
) -> DataFrame:
    """Exact quantiles of ``(by..., value, n)``: ``(by..., prob, quantile)``.

    ``interpolate=False`` returns an observed value (the smallest whose cumulative share
    reaches the probability); ``True`` interpolates linearly. Two bucket levels narrow each
    rank to about a thousandth of a 0.4 % bucket before any value is ordered.

    ``fixed_groups`` says the groups are listed in code (segments, metrics) and not found in
    the data. The buckets holding a wanted rank are then at most groups x probabilities rows,
    and are broadcast; otherwise Spark chooses the join on measured size.
    """
    small = F.broadcast if fixed_groups else (lambda df: df)
    keys = [*by]
    keyed = counts.select(*keys, "value", "n", _bucket(F.col("value")).alias("_b"))

    level0 = keyed.groupBy(*keys, "_b").agg(
        F.sum("n").alias("_m"), F.min("value").alias("_min"), F.max("value").alias("_max")
    )
    level0 = level0.select(
        "*",
        F.sum("_m").over(_running("_b", keys)).alias("_upto"),
        F.sum("_m").over(W.partitionBy(*keys)).alias("_total"),
    )
    hits0 = (
        level0.select(
            *keys,
            "_b",
            "_min",
            "_max",
            (F.col("_upto") - F.col("_m")).alias("_before"),
            "_upto",
            F.explode(_wanted_ranks(probs, F.col("_total"), interpolate)).alias("_w"),
        )
        .where((F.col("_w.rank") > F.col("_before")) & (F.col("_w.rank") <= F.col("_upto")))
    )
    span = F.col("_max") - F.col("_min")
    sub_bucket = F.when(
        span > 0, F.floor((F.col("value") - F.col("_min")) / span * (_SUB_BUCKETS - 1))
    )
    buckets = hits0.groupBy(*keys, "_b").agg(
        F.first("_min").alias("_min"),
        F.first("_max").alias("_max"),
        F.first("_before").alias("_before"),
        F.collect_list("_w").alias("_ws"),
    )
    narrowed = keyed.join(small(buckets), on=[*keys, "_b"]).select(
        *keys,
        "_b",
        "value",
        "n",
        "_before",
        "_ws",
        F.coalesce(sub_bucket.cast("int"), F.lit(0)).alias("_s"),
    )
    level1 = narrowed.groupBy(*keys, "_b", "_s").agg(
        F.sum("n").alias("_m"), F.first("_before").alias("_before"), F.first("_ws").alias("_ws")
    )
    level1 = level1.select(
        "*",
        (F.col("_before") + F.sum("_m").over(_running("_s", [*keys, "_b"]))).alias("_upto"),
    )
    hits1 = level1.select(
        *keys,
        "_b",
        "_s",
        (F.col("_upto") - F.col("_m")).alias("_off"),
        F.filter(
            "_ws",
            lambda w: (w["rank"] > F.col("_upto") - F.col("_m")) & (w["rank"] <= F.col("_upto")),
        ).alias("_ranks"),
    ).where(F.size("_ranks") > 0)

    upto = F.col("_off") + F.sum("n").over(_running("value", [*keys, "_b", "_s"]))
    picked = (
        narrowed.select(*keys, "_b", "_s", "value", "n")
        .join(small(hits1), on=[*keys, "_b", "_s"])
        .select(*keys, "value", "n", "_ranks", upto.alias("_upto"))
        .select(*keys, "value", "n", "_upto", F.explode("_ranks").alias("_w"))
        .where(
            (F.col("_w.rank") > F.col("_upto") - F.col("n")) & (F.col("_w.rank") <= F.col("_upto"))
        )
    )
    if not interpolate:
        return picked.select(*keys, F.col("_w.prob").alias("prob"), F.col("value").alias("quantile"))
    low, high = (
        F.max(F.when(F.col("_w.part") == part, F.col("value"))) for part in ("lo", "hi")
    )
    return (
        picked.groupBy(*keys, F.col("_w.prob").alias("prob"))
        .agg(low.alias("_lo"), high.alias("_hi"), F.max("_w.fraction").alias("_f"))
        .select(
            *keys,
            "prob",
            (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("quantile"),
        )
    )


def quantile_columns(quantiles: DataFrame, by: Sequence[str], names: Mapping[str, float]) -> DataFrame:
    """One row per group with a named column per probability."""
    return quantiles.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(name)
            for name, p in names.items()
        ]
    )
