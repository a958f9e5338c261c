import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.models.counts import (
    coefficient_rows,
    count_log_likelihoods,
    design_rank,
    find_aliases,
    fit_negative_binomial,
    fit_poisson,
    from_glm,
    nb_alpha,
    pearson_dispersion,
    require_full_rank,
)
from tidegrid.models.design import (
    Design,
    apply_fill,
    apply_scale,
    fit_fill,
    fit_levels,
    apply_levels,
    fit_scale,
    glm_design,
    require_complete,
    unseen_levels,
)
from tidegrid.models.trees import TreeFeatures, fit_gbt, permutation_importance, permute_columns, predict_value


@pytest.fixture(scope="module")
def counts(spark):
    rng = np.random.default_rng(11)
    n = 600
    frame = pd.DataFrame(
        {"hour": rng.integers(0, 4, n), "entity": rng.choice(["A", "B"], n), "x": rng.normal(size=n)}
    )
    mean = np.exp(1.0 + 0.3 * frame["hour"] - 0.5 * (frame["entity"] == "B") + 0.4 * frame["x"])
    frame["y"] = rng.negative_binomial(4, 4 / (4 + mean))
    return frame


@pytest.fixture(scope="module")
def designed(spark, counts):
    design = glm_design({"hour": [0, 1, 2, 3], "entity": ["A", "B"]}, ("hour", "entity"), [], [], ["x"])
    return design, design.transform(spark.createDataFrame(counts)).cache()


def numpy_design(frame):
    cols = [np.ones(len(frame))]
    hours = [(frame["hour"] == h).to_numpy(float) for h in (1, 2, 3)]
    b = (frame["entity"] == "B").to_numpy(float)
    cols += hours + [b] + [h * b for h in hours] + [frame["x"].to_numpy()]
    return np.column_stack(cols)


def irls(x, y, alpha):
    beta = np.zeros(x.shape[1])
    beta[0] = math.log(y.mean())
    for _ in range(200):
        eta = x @ beta
        mu = np.exp(eta)
        z, w = eta + (y - mu) / mu, mu / (1 + alpha * mu)
        new = np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (w * z))
        if np.abs(new - beta).max() < 1e-12:
            break
        beta = new
    return new


def test_poisson_and_negative_binomial_match_brute_force(counts, designed):
    design, df = designed
    x, y = numpy_design(counts), counts["y"].to_numpy(float)
    assert len(design.names) + 1 == x.shape[1]
    poisson = fit_poisson(df, "y")
    got = np.append(poisson.intercept, poisson.coefficients.toArray())
    assert np.allclose(got, irls(x, y, 0.0), atol=1e-6)
    start = from_glm(poisson)
    mu = np.exp(x @ irls(x, y, 0.0))
    scored = start.predict(df, "mu")
    alpha = nb_alpha(scored, "y", "mu").head()["alpha"]
    assert alpha == pytest.approx((((y - mu) ** 2 - y) / mu * mu).sum() / (mu * mu).sum(), rel=1e-5)
    nb = fit_negative_binomial(df, "y", alpha, start)
    assert nb.converged
    assert np.allclose(np.append(nb.intercept, nb.coefficients), irls(x, y, alpha), atol=1e-5)
    same = fit_negative_binomial(df, "y", 1e-9, start)
    assert np.allclose(same.coefficients, poisson.coefficients.toArray(), atol=1e-4)
    phi = pearson_dispersion(scored, "y", "mu", x.shape[1]).head()["dispersion"]
    assert phi == pytest.approx((((y - mu) ** 2) / mu).sum() / (len(y) - x.shape[1]), rel=1e-5)
    rows = coefficient_rows(design.names, poisson, phi)
    assert rows[-1][0] == "Intercept" and all(r[5] < r[4] < r[6] for r in rows)
    cov = np.linalg.inv(x.T @ (x * mu[:, None])) * phi
    assert rows[-1][2] == pytest.approx(math.sqrt(cov[0, 0]), rel=1e-4)
    mu_nb = np.exp(x @ irls(x, y, alpha))
    both = nb.predict(scored, "mu_nb")
    llf = count_log_likelihoods(both, "y", "mu", "mu_nb", alpha).head()
    want_p = sum(k * math.log(m) - m - math.lgamma(k + 1) for k, m in zip(y, mu))
    r = 1 / alpha
    want_n = sum(
        math.lgamma(k + r) - math.lgamma(r) - math.lgamma(k + 1)
        + k * math.log(alpha * m / (1 + alpha * m)) - r * math.log(1 + alpha * m)
        for k, m in zip(y, mu_nb)
    )
    assert llf["poisson_llf"] == pytest.approx(want_p, rel=1e-6)
    assert llf["nb_llf"] == pytest.approx(want_n, rel=1e-6)


def test_an_exact_alias_is_found_before_the_fit(spark, designed):
    design, df = designed
    assert design_rank(df) == (9, 9)
    alias = Design((*design.terms, ("copy", F.col("x") * 2 - (F.col("hour") == 1).cast("double"))))
    bad = alias.transform(df.drop("features"))
    assert design_rank(bad) == (10, 9)
    constant = Design((*design.terms, ("one", F.lit(1.0))))
    assert design_rank(constant.transform(df.drop("features"))) == (10, 9)
    with pytest.raises(ValueError, match="rank"):
        require_full_rank(bad)
    found = find_aliases(bad, [*design.names, "copy"])
    assert [a.column for a in found] == ["copy"] and abs(found[0].intercept) < 1e-9
    assert dict(found[0].parts) == pytest.approx({"x": 2.0, "hour[1]": -1.0})
    told = find_aliases(constant.transform(df.drop("features")), [*design.names, "one"])
    assert [(a.column, a.intercept, a.parts) for a in told] == [("one", 1.0, ())]
    assert find_aliases(df, design.names) == []
    with pytest.raises(ValueError, match="copy = .*2\\*x"):
        require_full_rank(bad, names=[*design.names, "copy"])


def test_a_feature_that_is_an_outcome_of_its_hour_is_refused():
    from tidegrid.plans.declared import Declared, require_no_leaks

    require_no_leaks([Declared("a"), Declared("b", role="leak_if_unlagged")])
    with pytest.raises(ValueError, match="'a'"):
        require_no_leaks([Declared("a"), Declared("a", role="leak_if_unlagged")])


def test_fill_and_scale_learn_from_training_only(spark):
    train = spark.createDataFrame([(1.0, None, None, 2.0), (5.0, 1.0, True, 2.0), (9.0, 3.0, False, 2.0)], "m double, z double, b boolean, c double")
    later = spark.createDataFrame([(None, None, None, 7.0)], "m double, z double, b boolean, c double")
    fill = fit_fill(train, ["z"], ["m"], ["b"])
    row = apply_fill(later, fill).head()
    assert tuple(row) == (5.0, 0.0, False, 7.0)
    with pytest.raises(ValueError, match="undocumented"):
        require_complete(later, ["m", "c"])
    scaled = apply_scale(later.fillna({"m": 5.0}), fit_scale(train, ["m", "c"])).head()
    assert (scaled["m"], scaled["c"]) == (0.0, 5.0)


def test_unseen_levels_fail(spark):
    train = spark.createDataFrame([("A", 1), ("B", 2)], "e string, d int")
    later = spark.createDataFrame([("C", 1)], "e string, d int")
    assert [tuple(r) for r in unseen_levels(train, later, ["e", "d"]).collect()] == [("e", "C")]
    model = fit_levels(train, ["e"])
    assert {r["e"]: r["e_index"] for r in apply_levels(model, train).collect()} == {"A": 0.0, "B": 1.0}
    with pytest.raises(Exception):
        apply_levels(model, later).collect()


def test_permuting_moves_a_block_together(spark):
    df = spark.range(5000).select("id", F.col("id").alias("a"), (F.col("id") * 2).alias("b"), F.lit(1).alias("c"))
    out = permute_columns(df, ["id"], ["a", "b"], 1).cache()
    assert out.count() == 5000 and out.select("id").distinct().count() == 5000
    assert out.select("a").distinct().count() == 5000
    assert out.where(F.col("b") != 2 * F.col("a")).count() == 0
    assert out.where(F.col("a") == F.col("id")).count() < 20
    again = permute_columns(df.repartition(3), ["id"], ["a", "b"], 1)
    assert again.exceptAll(out).count() == 0


def test_declared_features_stay_what_they_are_at_any_size(spark):
    features = TreeFeatures(numeric=("few", "many"), categorical=("kind",))
    for n in (60, 3000):
        df = spark.range(n).select(
            (F.col("id") % 3).alias("few"),
            F.col("id").alias("many"),
            F.concat(F.lit("k"), F.col("id") % 4).alias("kind"),
            (F.col("id") % 4).cast("double").alias("y"),
        )
        model = fit_gbt(df, features, "y", {"step": 0.5, "leaves": 4, "rounds": 2})
        assert model.bins.levels == (("k0", "k1", "k2", "k3"),) and len(model.bins.cuts) == 2
        assert model.bins.cuts[0] == (0.0, 1.0, 2.0)
    with pytest.raises(Exception, match="[Uu]nseen"):
        predict_value(model, df.withColumn("kind", F.lit("new")), "p").collect()
    with pytest.raises(ValueError, match="levels"):
        fit_gbt(df, TreeFeatures(numeric=(), categorical=("many",)), "y", {"step": 0.5, "leaves": 4, "rounds": 2})


def test_trees_of_a_constant_target_predict_it(spark):
    df = spark.range(50).select(F.col("id").alias("x"), F.lit(7.5).alias("y"))
    features = TreeFeatures(numeric=("x",))
    model = fit_gbt(df, features, "y", {"step": 0.1, "leaves": 4, "rounds": 2})
    assert {r["p"] for r in predict_value(model, df, "p").collect()} == {7.5}
    flat = permutation_importance(df, model, "y", ["x"], {"x": ["x"]})
    assert flat.head()["rmse_increase"] == 0 and flat.head()["repeats"] == 5


def test_trees_use_missingness_and_importance_ranks_it(spark):
    rng = np.random.default_rng(2)
    n = 400
    x = rng.normal(size=n)
    hole = rng.random(n) < 0.3
    frame = pd.DataFrame({"id": range(n), "x": np.where(hole, np.nan, x), "noise": rng.normal(size=n), "k": rng.integers(0, 3, n) * 1.0})
    frame["y"] = np.where(hole, 5.0, np.where(x > 0, 2.0, -2.0)) + 0.1 * rng.normal(size=n)
    df = spark.createDataFrame(frame).select("id", F.nanvl("x", F.lit(None)).alias("x"), "noise", "k", "y").cache()
    features = TreeFeatures(numeric=("x", "noise"), categorical=("k",))
    model = fit_gbt(df, features, "y", {"step": 0.3, "leaves": 8, "rounds": 5})
    scored = predict_value(model, df, "p")
    rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("p"), F.lit(2.0))))).head()[0]
    assert rmse < 1.0
    found = permutation_importance(df, model, "y", ["id"], {"x": ["x"], "noise": ["noise"]}, repeats=2).collect()
    by = {r["block"]: r["rmse_increase"] for r in found}
    assert by["x"] > 10 * abs(by["noise"])


def test_models_and_predictions_survive_saving(spark, tmp_path):
    from pyspark.ml.regression import GeneralizedLinearRegression

    from tidegrid.models.counts import from_glm
    from tidegrid.models.persist import load_glm, load_log_linear, load_trees, save_log_linear, save_model, save_predictions, save_trees

    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    features = TreeFeatures(numeric=("x",))
    trees = fit_gbt(df, features, "y", {"step": 0.3, "leaves": 4, "rounds": 3})
    save_trees(spark, trees, str(tmp_path / "trees"))
    again = load_trees(spark, str(tmp_path / "trees"))
    expected = [r["p"] for r in predict_value(trees, df, "p").orderBy("id").collect()]
    assert [r["p"] for r in predict_value(again, df, "p").orderBy("id").collect()] == expected

    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    glm = GeneralizedLinearRegression(family="poisson", link="log", labelCol="y").fit(rows)
    save_model(glm, str(tmp_path / "glm"))
    assert from_glm(load_glm(str(tmp_path / "glm"))) == from_glm(glm)
    save_log_linear(spark, from_glm(glm), str(tmp_path / "nb"))
    assert load_log_linear(spark, str(tmp_path / "nb")) == from_glm(glm)
    save_predictions(from_glm(glm).predict(rows, "mu"), str(tmp_path / "scored"), ["id"], ["y", "mu"])
    assert spark.read.parquet(str(tmp_path / "scored")).columns == ["id", "y", "mu"]


def test_a_holiday_given_twice_is_an_error(spark):
    from tidegrid.functions.calendar import with_holidays

    days = spark.sql("SELECT DATE '2024-01-01' AS date")
    twice = spark.sql("SELECT DATE '2024-01-01' AS date, h AS holiday_name, 'federal' AS holiday_kind FROM VALUES ('a'), ('b') AS t(h)")
    assert with_holidays(days, twice.limit(1)).count() == 1
    with pytest.raises(Exception, match="two holidays"):
        with_holidays(days, twice).collect()
