"""Saving fitted models and prediction tables beside each other, and reading them again."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

import numpy as np
from pyspark.ml.regression import GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

from tidegrid.models.boosting import Bins, Ensemble, Tree, TreeFeatures
from tidegrid.models.counts import LogLinear

LOG_LINEAR = "coefficients array<double>, intercept double, iterations int, converged boolean"


NODES = "tree int, node int, feature int, left int, right int, lefts binary, value double"


def save_model(model: GeneralizedLinearRegressionModel, path: str) -> None:
    """A fitted count GLM, replacing what was there."""
    model.write().overwrite().save(path)


def save_trees(spark: SparkSession, model: Ensemble, path: str) -> None:
    """Boosted trees: one row a node, beside one row of bins and first score."""
    nodes = [
        (t, i, int(tree.feature[i]), int(tree.left[i]), int(tree.right[i]), np.packbits(tree.lefts[i]).tobytes(), float(tree.value[i]))
        for t, tree in enumerate(model.trees)
        for i in range(len(tree.feature))
    ]
    spark.createDataFrame(nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
    head = json.dumps({"bins": asdict(model.bins), "base": model.base})
    spark.createDataFrame([(head,)], "head string").write.mode("overwrite").parquet(f"{path}/head")


def load_trees(spark: SparkSession, path: str) -> Ensemble:
    head = json.loads(spark.read.schema("head string").parquet(f"{path}/head").head()["head"])
    bins, trees = head["bins"], {}
    for r in spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # a model's nodes
        tree = trees.setdefault(r["tree"], Tree([], [], [], [], []))
        tree.feature.append(r["feature"])
        tree.left.append(r["left"])
        tree.right.append(r["right"])
        tree.lefts.append(np.unpackbits(np.frombuffer(r["lefts"], dtype=np.uint8)).astype(bool))
        tree.value.append(r["value"])
    features = TreeFeatures(**{k: tuple(v) for k, v in bins["features"].items()})
    parts = {k: tuple(map(tuple, bins[k])) for k in ("cuts", "levels")}
    whole = [Tree(*map(np.array, (t.feature, t.left, t.right, t.lefts, t.value))) for _, t in sorted(trees.items())]
    return Ensemble(Bins(features, **parts), head["base"], tuple(whole))


def load_glm(path: str) -> GeneralizedLinearRegressionModel:
    return GeneralizedLinearRegressionModel.load(path)


def save_log_linear(spark: SparkSession, model: LogLinear, path: str) -> None:
    """Coefficients of a log-linear model that was fitted by reweighting: one row."""
    row = (list(map(float, model.coefficients)), float(model.intercept), int(model.iterations), bool(model.converged))
    spark.createDataFrame([row], LOG_LINEAR).write.mode("overwrite").json(path)


def load_log_linear(spark: SparkSession, path: str) -> LogLinear:
    row = spark.read.schema(LOG_LINEAR).json(path).head()
    return LogLinear(tuple(row["coefficients"]), row["intercept"], row["iterations"], row["converged"])


def save_predictions(df: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str]) -> None:
    """Keys with actual and fitted columns, as Parquet; vectors of the design stay behind."""
    df.select(*keys, *columns).write.mode("overwrite").parquet(path)
