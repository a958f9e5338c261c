"""Forecast tables: naive predictions for evaluation, and fitted count and value models."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.models.counts import Alias, LogLinear, find_aliases, fit_negative_binomial, fit_poisson, from_glm, nb_alpha, require_full_rank
from tidegrid.models.design import (
    Design,
    apply_fill,
    apply_scale,
    fit_fill,
    fit_scale,
    glm_design,
    levels_of,
    require_complete,
)
from tidegrid.models.trees import TreeFeatures
from tidegrid.plans import sites
from tidegrid.plans.declared import features, filled, require_no_leaks
from tidegrid.plans.model_table import DECLARED, history_table, model_table
from tidegrid.sources.staging import stage

NUMBERS = [c for c in features(DECLARED, "number") if c.name != "hour"]
ZERO_FILL = filled(DECLARED, "zero")
MEDIAN_FILL = filled(DECLARED, "median")
BOOLEANS = [c.name for c in features(DECLARED, "flag")]
INDICATORS = [c.name for c in features(sites.DECLARED, "flag")]
#: Terms of the linear design: no exact combination of others, and no past values, which the trees use.
CONTINUOUS = [c.name for c in NUMBERS if not c.made_of and c.group != "past_values"]
#: An exact combination with what it is made of: permuted together, since each gives the others back.
ALIAS = next(c for c in NUMBERS if c.made_of)
COLLINEAR = [ALIAS.name, *ALIAS.made_of]
TREE_NUMBERS = [c for c in NUMBERS if c.group not in ("past_counts", "elsewhere")]
TREES = TreeFeatures(
    numeric=("hour", *[c.name for c in TREE_NUMBERS]),
    booleans=tuple(BOOLEANS),
    categorical=tuple(c.name for c in features(DECLARED, "level")),
)


def naive_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with weekly history, scored by last week's count and a trailing-mean value.

    ``pred_n`` is the trailing mean (never zero where used as a rate), ``pred_value`` last
    week's value where there was one, else the trailing mean.
    """
    rows = history_table(spark, sf_dir).where(F.col("has_count_history"))
    return rows.select(
        "*",
        (F.col("n_same_hour_7d") + 0.5).alias("pred_n"),
        F.coalesce("value_lag_168h", "value_same_hour_7d").alias("pred_value"),
        (F.col("n_events") - (F.col("n_same_hour_7d") + 0.5)).alias("residual"),
    )


@dataclass
class CountStudy:
    """Everything the count models share: staged rows, the design and what was learned.

    ``aliases`` are the terms left out because earlier ones give them back on every training row.
    """

    train: DataFrame
    test: DataFrame
    design: Design
    continuous: list[str]
    aliases: tuple[Alias, ...] = ()


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model table, staged once: the fits below read it many times."""
    return stage(model_table(spark, sf_dir).where(F.col("has_count_history")))


def count_study(spark: SparkSession, sf_dir: str) -> CountStudy:
    """Training-only fill and scale, and a design of hour x entity, weekdays and terms.

    Indicators without variation in training are left out, as they repeat the intercept. So are
    terms that the training rows cannot tell from earlier ones, such as two conditions that hold
    in the same hours: no coefficient of theirs is determined, and the fitted means stay the same.
    """
    table = _usable(spark, sf_dir)
    train = table.where(F.col("split") == "train")
    fill = fit_fill(train, ZERO_FILL, MEDIAN_FILL, BOOLEANS)
    filled = apply_fill(table, fill)
    filled_train = filled.where(F.col("split") == "train")
    require_no_leaks(DECLARED)
    require_complete(filled, [*INDICATORS, *CONTINUOUS])
    scale = fit_scale(filled_train, CONTINUOUS)
    varying = [c for c in CONTINUOUS if scale[c][1] > 0]
    scaled = apply_scale(filled, scale)
    levels = {c: levels_of(train, c) for c in ("hour", "entity", "day_of_week")}
    design = glm_design(
        levels,
        ("hour", "entity"),
        ["day_of_week"],
        [c for c in INDICATORS if _varies(filled_train, c)],
        varying,
    )
    scaled_train, scaled_test = (scaled.where(F.col("split") == s) for s in ("train", "test"))
    aliases = tuple(find_aliases(design.transform(scaled_train), design.names))
    design = design.without({a.column for a in aliases})
    return CountStudy(design.transform(scaled_train), design.transform(scaled_test), design, varying, aliases)


def _varies(df: DataFrame, column: str) -> bool:
    low, high = df.agg(F.min(column), F.max(column)).head()
    return low != high


@dataclass
class CountFits:
    study: CountStudy
    poisson: object
    negative_binomial: LogLinear
    alpha: float

    def scored(self, part: DataFrame) -> DataFrame:
        """A part with both models' fitted means."""
        both = from_glm(self.poisson).predict(part, "pred_n")
        return self.negative_binomial.predict(both, "pred_n_nb")


def fit_counts(spark: SparkSession, sf_dir: str) -> CountFits:
    """Poisson, then the dispersion it leaves, then a negative binomial on the same design.

    A leaking feature, a null left after filling, an alias that the study left in the design or a
    fit that does not converge is an error.
    """
    study = count_study(spark, sf_dir)
    require_full_rank(study.train, names=study.design.names)
    poisson = fit_poisson(study.train, "n_events")
    start = from_glm(poisson)
    alpha = nb_alpha(start.predict(study.train, "_mu"), "n_events", "_mu").head()["alpha"]
    nb = fit_negative_binomial(study.train, "n_events", alpha, start)
    if not nb.converged:
        raise ValueError(f"the negative binomial did not converge in {nb.iterations} steps")
    return CountFits(study, poisson, nb, alpha)


def value_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows where the value target is defined; a leaking feature is an error."""
    require_no_leaks(DECLARED)
    table = _usable(spark, sf_dir).where(F.col("mean_value").isNotNull())
    return table.where(F.col("split") == "train"), table.where(F.col("split") == "test")


def reference_constants(weekday: int = 3) -> Mapping[str, Column]:
    """An ordinary midweek day: no holiday, dry, not freezing."""
    off = F.lit(False)
    return {
        "day_of_week": F.lit(weekday),
        "is_holiday": off,
        "is_holiday_adjacent": off,
        "is_wet": off,
        "is_freezing": off,
    }
