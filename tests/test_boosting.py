"""Histogram boosting against brute force, and the keyed bijection of permutations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.models import boosting as bo
from tidegrid.models.trees import permutation_importance, permute_columns, permuted_number, tune_forward


def rows(seed, n=300, numbers=3, sets=1):
    random = np.random.default_rng(seed)
    codes = random.integers(0, 12, (n, numbers + sets)).astype(np.uint8)
    gradient = np.rint(random.normal(size=n) * 1000 + 800 * (codes[:, 0] > 6) + 600 * (codes[:, 1] == 0) + 900 * np.isin(codes[:, -1], (2, 5, 7)))
    return codes, gradient, np.rint(random.integers(1, 4, n)).astype(float)


def gain_of(left, gradient, weight):
    def part(at):
        return gradient[at].sum() ** 2 / weight[at].sum()

    return part(left) + part(~left) - gradient.sum() ** 2 / weight.sum()


@pytest.mark.parametrize("seed", range(6))
def test_the_best_split_is_the_best_of_all_that_may_be_tried(seed):
    codes, gradient, weight = rows(seed)
    histogram = bo.sums_by_bin(codes, np.zeros(len(codes), dtype=int), 1, gradient, weight)[0]
    found = bo.best_split(histogram, 3, 20)
    tried = []
    for j in range(4):
        order = list(range(1, 12))
        if j == 3:
            mean = {b: gradient[codes[:, j] == b].sum() / weight[codes[:, j] == b].sum() for b in order if (codes[:, j] == b).any()}
            order = sorted(mean, key=mean.get)
        for k in range(1, len(order) + 1):
            for missing in (True, False):
                left = np.isin(codes[:, j], order[:k]) | (missing & (codes[:, j] == 0))
                if 20 <= left.sum() <= len(left) - 20:
                    tried.append(gain_of(left, gradient, weight))
    left = found.lefts[codes[:, found.feature]]
    assert found.gain == pytest.approx(max(tried)) and gain_of(left, gradient, weight) == pytest.approx(found.gain)


def test_trees_grow_best_leaf_first():
    codes, gradient, weight = rows(9, n=600)
    leaves = {0: np.ones(len(codes), dtype=bool)}
    made = []  # plain best-first growth, one split at a time
    for _ in range(5):
        best = None
        for key, member in leaves.items():
            s = bo.best_split(bo.sums_by_bin(codes[member], np.zeros(member.sum(), dtype=int), 1, gradient[member], weight[member])[0], 3, 20)
            if s.feature >= 0 and (best is None or s.gain > best[0]):
                best = (s.gain, key, s)
        _, key, s = best
        member = leaves.pop(key)
        goes = s.lefts[codes[:, s.feature]]
        leaves[len(made) * 2 + 1], leaves[len(made) * 2 + 2] = member & goes, member & ~goes
        made.append(s)

    def histograms(tree, nodes):
        leaf = tree.leaf_of(codes)
        return {n: bo.sums_by_bin(codes[leaf == n], np.zeros((leaf == n).sum(), dtype=int), 1, gradient[leaf == n], weight[leaf == n])[0] for n in nodes}

    tree = bo.grow(histograms, 3, 6, 20, 0.5, 1.0)
    assert (tree.feature < 0).sum() == 6
    predicted = tree.predict(codes)
    for member in leaves.values():
        assert set(predicted[member]) == {0.5 * gradient[member].sum() / weight[member].sum()}


def table(spark, n=900):
    random = np.random.default_rng(4)
    x, z = random.normal(size=n), random.normal(size=n)
    hole = random.random(n) < 0.2
    kind = random.integers(0, 5, n)
    y = np.where(hole, 3.0, np.sin(2 * x)) + 0.3 * (kind == 2) + 0.1 * random.normal(size=n)
    data = [(i, None if h else float(a), float(b), f"k{k}", bool(a > 0), float(v), 1.0 + i % 3) for i, (h, a, b, k, v) in enumerate(zip(hole, x, z, kind, y))]
    return spark.createDataFrame(data, "id long, x double, z double, kind string, flag boolean, y double, w double")


FEATURES = bo.TreeFeatures(numeric=("x", "z"), booleans=("flag",), categorical=("kind",))


@pytest.mark.parametrize("weight", [None, "w"])
def test_one_task_and_many_jobs_make_the_same_trees(spark, weight):
    df = table(spark).repartition(3)
    setting = bo.Setting(0.3, 7, 12)
    (here,) = bo.fit_ensembles(df, FEATURES, "y", [setting], weight)
    (jobs,) = bo.fit_ensembles(df.repartition(5), FEATURES, "y", [setting], weight, local_bytes=0)
    assert here.bins == jobs.bins and here.base == pytest.approx(jobs.base, rel=1e-12)
    for a, b in zip(here.trees, jobs.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.lefts == b.lefts).all() and np.allclose(a.value, b.value, rtol=1e-9)
    got = bo.predict(df, {"p": (here, None), "early": (here, 2)})
    rmse = got.agg(*[F.sqrt(F.avg((F.col("y") - F.col(c)) ** 2)).alias(c) for c in ("p", "early")]).head()
    assert rmse["p"] < 0.25 < rmse["early"]


def test_missing_values_go_to_a_side_of_their_own(spark):
    df = table(spark)
    (model,) = bo.fit_ensembles(df, bo.TreeFeatures(numeric=("x",)), "y", [bo.Setting(1.0, 2, 1)])
    assert len(model.trees[0].feature) == 3 and not model.trees[0].lefts[0][0] and model.trees[0].lefts[0][1]
    odd = spark.createDataFrame([(None,), (float("nan"),), (0.1,)], "x double")
    a, b, c = (r["p"] for r in bo.predict(odd, {"p": (model, None)}).collect())
    assert a == b and a != c


def test_no_rows_few_rows_and_one_value(spark):
    df = table(spark)
    with pytest.raises(ValueError, match="no rows"):
        bo.fit_ensembles(df.limit(0), FEATURES, "y", [bo.Setting(0.1, 4, 2)])
    (few,) = bo.fit_ensembles(df.limit(10), FEATURES, "y", [bo.Setting(0.1, 4, 2)])
    assert all(len(t.feature) == 1 for t in few.trees)
    (same,) = bo.fit_ensembles(df.withColumn("x", F.lit(1.0)), bo.TreeFeatures(numeric=("x",)), "y", [bo.Setting(0.1, 4, 2)])
    assert len(same.trees[0].feature) == 1


def test_tuning_scores_shorter_fits_by_the_first_rounds(spark):
    df = table(spark).withColumn("date", F.expr("date_add(DATE '2024-01-01', CAST(id DIV 50 AS INT))"))
    grid = [{"step": 0.3, "leaves": 4, "rounds": r} for r in (1, 6)]
    tuned = tune_forward(df, FEATURES, "y", "date", "2024-01-12", grid).collect()
    before, after = df.where("date < '2024-01-12'"), df.where("date >= '2024-01-12'")
    for row in tuned:
        (alone,) = bo.fit_ensembles(before, FEATURES, "y", [bo.Setting(0.3, 4, row["rounds"])])
        told = bo.predict(after, {"p": (alone, None)}).agg(F.sqrt(F.avg((F.col("y") - F.col("p")) ** 2))).head()[0]
        assert row["valid_rmse"] == pytest.approx(told) and row["n"] == after.count()
    assert [r["position"] for r in tuned] == [1, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000, 1024, 9999])
def test_permuted_numbers_are_a_bijection(spark, n):
    told = spark.range(n).select("id", *[permuted_number(F.col("id"), n, F.lit(s)).alias(f"p{s}") for s in (1, 2)]).collect()
    for s in (1, 2):
        assert sorted(r[f"p{s}"] for r in told) == list(range(n))
    if n >= 1000:
        assert sum(r["p1"] == r["id"] for r in told) < 20 and sum(r["p1"] == r["p2"] for r in told) < 20
        assert abs(np.corrcoef([r["id"] for r in told], [r["p1"] for r in told])[0, 1]) < 0.1


def test_importance_equals_scoring_permuted_columns(spark):
    df = table(spark).where("id < 400")
    (model,) = bo.fit_ensembles(df, FEATURES, "y", [bo.Setting(0.3, 6, 8)])

    def rmse(frame):
        return bo.predict(frame, {"p": (model, None)}).agg(F.sqrt(F.avg((F.col("y") - F.col("p")) ** 2))).head()[0]

    blocks = {"x": ["x"], "both": ["x", "flag"], "z": ["z"]}
    found = {r["block"]: r for r in permutation_importance(df, model, "y", ["id"], blocks, repeats=1, seed=5).collect()}
    for name, columns in blocks.items():
        told = rmse(permute_columns(df, ["id"], columns, 5)) - rmse(df)
        assert found[name]["rmse_increase"] == pytest.approx(told, abs=1e-9) and found[name]["repeats"] == 1
