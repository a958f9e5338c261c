"""Imputation, scaling, levels, count models, boosted trees and permutation importance.

Where a model has a closed form (a saturated factor fits its cell means) the query has an
oracle. The full-design fits have none; their operators are checked on fixtures in the tests.
Fits are made once per session and folder and shared by the queries that report on them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.history_queries import HISTORY
from tidegrid.catalog.registry import HOURS, query, rounded
from tidegrid.models.counts import (
    coefficient_table,
    count_log_likelihoods,
    design_rank,
    find_aliases,
    fit_poisson,
    from_glm,
    nb_alpha,
    pearson_dispersion,
    quasi_summary,
)
from tidegrid.models.design import (
    Design,
    apply_fill,
    apply_levels,
    apply_scale,
    fit_fill,
    fit_levels,
    fit_scale,
    glm_design,
    scale_statistics,
    train_medians,
    unseen_levels,
)
from tidegrid.models.trees import (
    TUNING_GRID,
    TreeFeatures,
    fit_gbt,
    fit_tuned,
    permutation_importance,
    permute_columns,
    predict_value,
    tune_forward,
    typical_profile,
    unseen_periods,
    weighting_comparison,
)
from tidegrid.operators.evaluate import (
    combine_revenue,
    comparison,
    peak_and_trough,
    poisson_deviance,
    residual_covariance,
    score_common,
)
from tidegrid.plans import forecasts
from tidegrid.plans.entity_hours import entity_hours
from tidegrid.plans.model_table import history_table
from tidegrid.plans.study import ENTITIES
from tidegrid.sources.staging import stage

VALIDATED_FROM = "2024-01-17"
_made: dict[tuple, object] = {}


def forget_fits() -> None:
    """Drop the shared fits, so that the next query pays for its own."""
    _made.clear()


def _once(spark, sf_dir, name, make):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _counts(spark, sf_dir):
    return _once(spark, sf_dir, "counts", lambda: forecasts.fit_counts(spark, sf_dir))


def _values(spark, sf_dir):
    return _once(spark, sf_dir, "values", lambda: forecasts.value_rows(spark, sf_dir))


def _tuned(spark, sf_dir):
    def make():
        train, _ = _values(spark, sf_dir)
        return tune_forward(train, forecasts.TREES, "mean_value", "date", VALIDATED_FROM, TUNING_GRID)

    return _once(spark, sf_dir, "tuned", make)


def _trees(spark, sf_dir, weight=None):
    def make():
        train, _ = _values(spark, sf_dir)
        return fit_tuned(train, _tuned(spark, sf_dir), forecasts.TREES, "mean_value", weight)

    return _once(spark, sf_dir, ("trees", weight), make)


TRAIN = HISTORY + ", train AS (SELECT * FROM hist WHERE split = 'train')"


@query(
    "train_medians",
    f"""WITH {TRAIN} SELECT 'value_lag_168h' AS column_name, round(quantile_cont(value_lag_168h, 0.5), 6) AS median FROM train
    UNION ALL SELECT 'n_lag_24h', quantile_cont(n_lag_24h, 0.5) FROM train UNION ALL SELECT 'value_same_hour_7d', round(quantile_cont(value_same_hour_7d, 0.5), 6) FROM train""",
)
def medians(spark, sf_dir):
    train = history_table(spark, sf_dir).where(F.col("split") == "train")
    return rounded(train_medians(train, ["value_lag_168h", "n_lag_24h", "value_same_hour_7d"]))


@query(
    "imputed",
    f"""WITH {TRAIN} SELECT date, hour, entity, coalesce(n_lag_1h, 0) AS n_lag_1h, round(coalesce(value_lag_168h, (SELECT quantile_cont(value_lag_168h, 0.5) FROM train)), 6) AS value_lag_168h FROM hist""",
)
def imputed(spark, sf_dir):
    table = stage(
        history_table(spark, sf_dir).select(
            "date", "hour", "entity", "split", "n_lag_1h", "value_lag_168h"
        )
    )
    fill = fit_fill(table.where(F.col("split") == "train"), ["n_lag_1h"], ["value_lag_168h"], [])
    out = apply_fill(table, fill).drop("split")
    return rounded(out.select("*", F.col("n_lag_1h").cast("long").alias("n")).drop("n_lag_1h").withColumnRenamed("n", "n_lag_1h"))


@query(
    "scale_statistics",
    f"""WITH {TRAIN} SELECT 'n_events' AS column_name, round(avg(n_events), 6) AS centre, round(stddev_pop(n_events), 6) AS spread FROM train
    UNION ALL SELECT 'sum_value', round(avg(sum_value), 6), round(stddev_pop(sum_value), 6) FROM train""",
)
def scales(spark, sf_dir):
    train = history_table(spark, sf_dir).where(F.col("split") == "train")
    return rounded(scale_statistics(train, ["n_events", "sum_value"]))


@query(
    "scaled",
    f"""WITH {TRAIN}, s AS (SELECT avg(n_events) AS a, stddev_pop(n_events) AS b, avg(sum_value) AS c, stddev_pop(sum_value) AS d FROM train)
    SELECT date, hour, entity, round((n_events - a) / b, 6) AS n_events, round((sum_value - c) / d, 6) AS sum_value FROM hist, s""",
)
def scaled(spark, sf_dir):
    hours = stage(entity_hours(spark, sf_dir).drop("mean_value"))
    train = hours.where(F.col("date") < F.lit("2024-01-22").cast("date"))
    return rounded(apply_scale(hours, fit_scale(train, ["n_events", "sum_value"])))


@query(
    "frozen_levels",
    f"""WITH {TRAIN}, l AS (SELECT entity, CAST(dense_rank() OVER (ORDER BY entity) - 1 AS DOUBLE) AS entity_index FROM (SELECT DISTINCT entity FROM train))
    SELECT h.entity, h.split, entity_index, count(*) AS row_count FROM hist h JOIN l ON l.entity = h.entity GROUP BY 1, 2, 3""",
)
def frozen(spark, sf_dir):
    table = history_table(spark, sf_dir).select("entity", "split")
    model = fit_levels(table.where(F.col("split") == "train"), ["entity"])
    return apply_levels(model, table).groupBy("entity", "split", "entity_index").agg(
        F.count("*").alias("row_count")
    )


@query(
    "unseen_levels",
    f"""WITH {HISTORY} SELECT DISTINCT 'date' AS column_name, CAST(date AS VARCHAR) AS level FROM hist WHERE split = 'test'""",
)
def unseen(spark, sf_dir):
    table = history_table(spark, sf_dir).select("entity", "day_of_week", "date", "split")
    train, test = (table.where(F.col("split") == s) for s in ("train", "test"))
    return unseen_levels(train, test, ["entity", "day_of_week", "date"])


def _saturated(spark, sf_dir):
    """A factor for every (hour, entity) cell, whose fitted Poisson means are the cell means."""

    def make():
        levels = {"hour": list(range(24)), "entity": list(ENTITIES)}
        design = glm_design(levels, ("hour", "entity"), [], [], [])
        rows = stage(design.transform(entity_hours(spark, sf_dir)))
        model = fit_poisson(rows, "n_events")
        return from_glm(model).predict(rows, "fitted")

    return _once(spark, sf_dir, "saturated", make)


CELL_MEANS = HISTORY + ", fit AS (SELECT *, avg(n_events) OVER (PARTITION BY entity, hour) AS mu FROM hist)"


@query(
    "glm_cell_means",
    f"WITH {CELL_MEANS} SELECT entity, hour, round(avg(mu), 5) AS fitted, count(*) AS n FROM fit GROUP BY 1, 2",
)
def cell_means(spark, sf_dir):
    fitted = _saturated(spark, sf_dir).groupBy("entity", "hour").agg(
        F.avg("fitted").alias("fitted"), F.count("*").alias("n")
    )
    return rounded(fitted, 5)


@query(
    "glm_dispersion",
    f"""WITH {CELL_MEANS} SELECT count(*) AS n, count(*) - 120 AS residual_dof, round(sum(pow(n_events - mu, 2) / mu), 4) AS pearson_chi2,
      round(sum(pow(n_events - mu, 2) / mu) / (count(*) - 120), 6) AS dispersion FROM fit""",
)
def dispersion_of_fit(spark, sf_dir):
    out = pearson_dispersion(_saturated(spark, sf_dir), "n_events", "fitted", 120)
    return out.select(
        "n",
        "residual_dof",
        F.round("pearson_chi2", 4).alias("pearson_chi2"),
        F.round("dispersion", 6).alias("dispersion"),
    )


@query(
    "nb_alpha",
    f"""WITH {CELL_MEANS} SELECT round(sum((pow(n_events - mu, 2) - n_events) / mu * mu) / sum(mu * mu), 6) AS alpha, count(*) AS n FROM fit""",
)
def alpha(spark, sf_dir):
    return rounded(nb_alpha(_saturated(spark, sf_dir), "n_events", "fitted"))


@query("glm_rank")
def rank_check(spark, sf_dir):
    """Columns and rank of the design, and of the same design with the exact alias put back."""
    study = _counts(spark, sf_dir).study
    planned, actual = forecasts.ALIAS.made_of
    aliased = Design((*study.design.terms, (forecasts.ALIAS.name, F.col(actual) - F.col(planned))))
    rows = []
    for name, design in (("design", study.design), ("aliased", aliased)):
        columns, rank = design_rank(design.transform(study.train.drop("features")))
        rows.append((name, columns, rank, rank == columns))
    return spark.createDataFrame(rows, "design string, columns int, rank int, identified boolean")


@query(
    "design_aliases",
    f"""WITH {HOURS}, x AS (SELECT hour::DOUBLE AS h, n_events::DOUBLE AS n, 2 * hour - 0.5::DOUBLE * n_events + 5 AS y FROM hours),
    s AS (SELECT covar_pop(y, h) AS yh, covar_pop(y, n) AS yn, covar_pop(h, n) AS hn, var_pop(h) AS hh, var_pop(n) AS nn, avg(y) AS my, avg(h) AS mh, avg(n) AS mn FROM x),
    b AS (SELECT (yh * nn - yn * hn) / (hh * nn - hn * hn) AS bh, (yn * hh - yh * hn) / (hh * nn - hn * hn) AS bn, my, mh, mn FROM s)
    SELECT 'mixed' AS column_name, 'hour' AS source, round(bh, 6) AS weight FROM b UNION ALL SELECT 'mixed', 'n_events', round(bn, 6) FROM b
    UNION ALL SELECT 'mixed', '(intercept)', round(my - bh * mh - bn * mn, 6) FROM b
    UNION ALL SELECT 'three', '(intercept)', round(avg(3.0::DOUBLE), 6) FROM x""",
)
def aliases(spark, sf_dir):
    """Columns of a design that earlier ones give back, with their weights: one mixed on purpose, one constant."""
    mixed = 2 * F.col("hour") - 0.5 * F.col("n_events") + 5
    terms = [(c, F.col(c)) for c in ("hour", "n_events", "sum_value")]
    design = Design((*terms, ("mixed", mixed), ("three", F.lit(3.0))))
    rows = stage(design.transform(entity_hours(spark, sf_dir).withColumn("sum_value", F.coalesce("sum_value", F.lit(0.0)))))
    found = [(a.column, source, weight) for a in find_aliases(rows, design.names) for source, weight in [*a.parts, ("(intercept)", a.intercept)]]
    return rounded(spark.createDataFrame(found, "column_name string, source string, weight double"))


@query("glm_poisson")
def poisson_scores(spark, sf_dir):
    """Both count models beside the benchmark on the test rows."""
    fits = _counts(spark, sf_dir)
    rows = [
        ("count", "last week", "n_events", "n_lag_168h", None),
        ("count", "poisson", "n_events", "pred_n", None),
        ("count", "negative binomial", "n_events", "pred_n_nb", None),
    ]
    return rounded(comparison(fits.scored(fits.study.test), rows))


@query("glm_deviance")
def model_deviance(spark, sf_dir):
    fits = _counts(spark, sf_dir)
    fitted = {"poisson": "pred_n", "negative_binomial": "pred_n_nb"}
    return rounded(poisson_deviance(fits.scored(fits.study.test), "n_events", fitted))


@query("glm_quasi")
def quasi(spark, sf_dir):
    fits = _counts(spark, sf_dir)
    parameters = len(fits.study.design.names) + 1
    return rounded(quasi_summary(fits.scored(fits.study.train), "n_events", "pred_n", parameters))


@query("glm_likelihoods")
def likelihoods(spark, sf_dir):
    """Log-likelihoods and AIC; the estimated alpha is charged to the negative binomial."""
    fits = _counts(spark, sf_dir)
    p = float(len(fits.study.design.names) + 1)
    llf = count_log_likelihoods(
        fits.scored(fits.study.train), "n_events", "pred_n", "pred_n_nb", max(fits.alpha, 1e-6)
    )
    return rounded(
        llf.select(
            "*",
            (F.lit(2 * p) - 2 * F.col("poisson_llf")).alias("poisson_aic"),
            (F.lit(2 * p + 2) - 2 * F.col("nb_llf")).alias("nb_aic"),
            F.lit(float(fits.alpha)).alias("alpha"),
        )
    )


@query("coefficient_table")
def coefficients(spark, sf_dir):
    fits = _counts(spark, sf_dir)
    study = fits.study
    parameters = len(study.design.names) + 1
    scored = fits.scored(study.train)
    phi = pearson_dispersion(scored, "n_events", "pred_n", parameters).head()["dispersion"]
    undetermined = [a.column for a in study.aliases]
    return rounded(coefficient_table(study.train, study.design.names, fits.poisson, phi, undetermined))


@query("typical_profile")
def typical(spark, sf_dir):
    """Peak and trough of an ordinary midweek day, conditions held at each hour's average."""
    fits = _counts(spark, sf_dir)
    profile = typical_profile(
        fits.study.train, ["entity", "hour"], fits.study.continuous, forecasts.reference_constants()
    )
    fitted = from_glm(fits.poisson).predict(fits.study.design.transform(profile), "fitted_rate")
    return rounded(peak_and_trough(fitted, "entity", "hour", "fitted_rate"))


@query("gbt_value")
def gbt(spark, sf_dir):
    """The value model against last week's value, on common and on full support."""
    _, test = _values(spark, sf_dir)
    scored = predict_value(_trees(spark, sf_dir), test, "pred_value")
    return rounded(score_common(scored, "mean_value", "pred_value", "value_lag_168h"))


@query(
    "gbt_single_split",
    f"""WITH {HOURS}, r AS (SELECT hour, CAST(day(date) AS INTEGER) AS day, mean_value AS y FROM hours WHERE mean_value IS NOT NULL),
    long AS (SELECT 'hour' AS feature, hour AS x, y FROM r UNION ALL SELECT 'day', day, y FROM r),
    tried AS (SELECT a.feature, c.x AS threshold, count(*) FILTER (a.x <= c.x) AS n_left, count(*) FILTER (a.x > c.x) AS n_right,
        sum(y) FILTER (a.x <= c.x) AS left_sum, sum(y) FILTER (a.x > c.x) AS right_sum
      FROM long a JOIN (SELECT DISTINCT feature, x FROM long) c ON c.feature = a.feature GROUP BY 1, 2),
    best AS (SELECT * FROM tried WHERE n_left >= 20 AND n_right >= 20
      ORDER BY left_sum * left_sum / n_left + right_sum * right_sum / n_right DESC LIMIT 1)
    SELECT feature, threshold, n_left AS n, round(left_sum / n_left, 6) AS value, true AS below FROM best
    UNION ALL SELECT feature, threshold, n_right, round(right_sum / n_right, 6), false FROM best""",
)
def single_split(spark, sf_dir):
    """One tree of one split, whole step: the threshold that lowers the squared error most, and the means of its sides."""
    rows = entity_hours(spark, sf_dir).where(F.col("mean_value").isNotNull()).select("hour", F.dayofmonth("date").alias("day"), "mean_value")
    rows = stage(rows)
    features = TreeFeatures(numeric=("hour", "day"))
    model = fit_gbt(rows, features, "mean_value", {"step": 1.0, "leaves": 2, "rounds": 1})
    tree = model.trees[0]
    name = features.sources[tree.feature[0]]
    scored = predict_value(model, rows, "value").withColumn("feature", F.lit(name)).withColumn("x", F.col(name))
    sides = scored.groupBy("feature", "value").agg(F.count("*").alias("n"), F.max("x").alias("high"))
    low = sides.agg(F.min("high")).head()[0]
    return rounded(sides.select("feature", F.lit(low).alias("threshold"), "n", "value", (F.col("high") == low).alias("below")))


@query(
    "gbt_constant",
    f"WITH {HOURS} SELECT entity, count(*) AS n, 7.5::DOUBLE AS low, 7.5::DOUBLE AS high FROM hours GROUP BY entity",
)
def constant(spark, sf_dir):
    """A target without variation is predicted as it is, whatever the features."""
    rows = stage(entity_hours(spark, sf_dir).select("hour", "entity", "n_events", F.lit(7.5).alias("y")))
    model = fit_gbt(rows, TreeFeatures(numeric=("hour", "n_events"), categorical=("entity",)), "y", {"step": 0.1, "leaves": 15, "rounds": 5})
    return predict_value(model, rows, "p").groupBy("entity").agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"))


@query("gbt_tuned")
def tuned(spark, sf_dir):
    return rounded(_tuned(spark, sf_dir))


@query(
    "unseen_periods",
    f"WITH {HISTORY} SELECT DISTINCT date FROM hist WHERE split = 'test'",
)
def periods(spark, sf_dir):
    table = history_table(spark, sf_dir)
    train, test = (table.where(F.col("split") == s) for s in ("train", "test"))
    return unseen_periods(train, test, "date")


@query("gbt_weighted")
def weighted(spark, sf_dir):
    """Plain against exposure-weighted trees on value and on revenue, count model fixed."""
    fits = _counts(spark, sf_dir)
    counts = fits.scored(fits.study.test).select("date", "hour", "entity", "pred_n")
    _, test = _values(spark, sf_dir)
    plain = predict_value(_trees(spark, sf_dir), test, "pred_plain")
    both = predict_value(_trees(spark, sf_dir, "n_events"), plain, "pred_weighted")
    scored = both.join(counts, on=["date", "hour", "entity"])
    return rounded(
        weighting_comparison(
            scored, ("mean_value", "pred_plain", "pred_weighted"), "sum_value", "pred_n"
        )
    )


@query("combined_revenue")
def combined(spark, sf_dir):
    """Fitted count times fitted value against the naive product, with the omitted covariance."""
    fits = _counts(spark, sf_dir)
    scored = predict_value(
        _trees(spark, sf_dir),
        fits.scored(fits.study.test).drop("features"),
        "pred_value",
    )
    revenue = combine_revenue(scored, "pred_n", "pred_value", "n_lag_168h", "value_lag_168h")
    return rounded(
        residual_covariance(
            revenue, ("n_events", "pred_n"), ("mean_value", "pred_value"), "sum_value"
        )
    )


def _importance(spark, sf_dir, blocks):
    _, test = _values(spark, sf_dir)
    model = _trees(spark, sf_dir)
    return rounded(permutation_importance(test, model, "mean_value", ["date", "hour", "entity"], blocks))


@query("permutation_importance")
def importance(spark, sf_dir):
    return _importance(spark, sf_dir, {c: [c] for c in forecasts.TREES.sources})


@query("grouped_importance")
def grouped_importance(spark, sf_dir):
    return _importance(spark, sf_dir, {"arrivals block": forecasts.COLLINEAR})


@query(
    "permuted_columns",
    """SELECT count(*) AS row_count, CAST(sum(event_id) AS BIGINT) AS key_sum, round(sum(value), 4) AS value_sum, true AS moved FROM events""",
)
def permuted(spark, sf_dir):
    """A permutation moves values between rows and loses none of them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", F.col("value").alias("before"))
    moved = permute_columns(events, ["event_id"], ["value"], 42)
    return rounded(
        moved.agg(
            F.count("*").alias("row_count"),
            F.sum("event_id").alias("key_sum"),
            F.sum("value").alias("value_sum"),
            (F.count_if(F.col("value") != F.col("before")) > 0.9 * F.count("*")).alias("moved"),
        ),
        4,
    )
