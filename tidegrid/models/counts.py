"""Count models: Poisson and negative-binomial GLMs, identification and quasi inference."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

TOLERANCE = 1e-10
MAX_ITERATIONS = 200


def fit_poisson(df: DataFrame, label: str, features: str = "features", regularisation: float = 0.0):
    """Poisson GLM with log link, iterated to a tight tolerance."""
    return GeneralizedLinearRegression(
        family="poisson",
        link="log",
        labelCol=label,
        featuresCol=features,
        tol=TOLERANCE,
        maxIter=MAX_ITERATIONS,
        regParam=regularisation,
    ).fit(df)


def design_rank(df: DataFrame, features: str = "features", tolerance: float = 1e-9) -> tuple[int, int]:
    """``(columns, rank)`` of the design with its intercept.

    Variances and the p x p correlation matrix are summed over rows in the cluster, and only
    they reach the driver. A column constant over the rows repeats the intercept.
    """
    variance = df.select(Summarizer.variance(F.col(features)).alias("v")).head()["v"].toArray()
    matrix = Correlation.corr(df, features).head()[0].toArray()
    varying = variance > 0
    eigenvalues = np.linalg.eigvalsh(matrix[np.ix_(varying, varying)])
    rank = 1 + int((eigenvalues > tolerance * eigenvalues.max()).sum())
    return len(variance) + 1, rank


@dataclass(frozen=True)
class Alias:
    """A design column that is ``intercept`` plus a weighted sum of earlier columns, on every row."""

    column: str
    intercept: float
    parts: tuple[tuple[str, float], ...]

    def __str__(self) -> str:
        return " ".join([f"{self.column} = {self.intercept:g}", *[f"{w:+g}*{name}" for name, w in self.parts]])


def find_aliases(df: DataFrame, names: Sequence[str], features: str = "features", tolerance: float = 1e-9) -> list[Alias]:
    """Columns of the design that earlier ones give back, each with its combination.

    Means, deviations and the p x p correlation matrix are summed over rows in the cluster. Their
    Cholesky factor is built column by column in the declared order: a column whose square that is
    left falls to ``tolerance`` adds nothing, and the factor gives its weights. It is left out, so a
    group of collinear columns loses as many as it has too many, and the earlier ones stay.
    """
    row = df.select(Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("s")).select("s.*").head()
    mean, spread = row["mean"].toArray(), np.sqrt(row["variance"].toArray())
    matrix = Correlation.corr(df, features).head()[0].toArray()
    factor = np.zeros((0, 0))
    kept: list[int] = []
    found = []
    for j, name in enumerate(names):
        if not spread[j] > 0:
            found.append(Alias(name, float(mean[j]), ()))
            continue
        part = np.linalg.solve(factor, matrix[kept, j]) if kept else np.zeros(0)
        left = 1.0 - part @ part
        if left <= tolerance:
            weights = np.linalg.solve(factor.T, part) * spread[j] / spread[kept]
            told = [(names[k], float(w)) for k, w in zip(kept, weights, strict=True) if abs(w) * spread[k] > 1e-6 * spread[j]]
            base = float(mean[j] - sum(w * mean[names.index(n)] for n, w in told))
            found.append(Alias(name, base, tuple(told)))
            continue
        grown = np.zeros((len(kept) + 1, len(kept) + 1))
        grown[:-1, :-1], grown[-1, :-1], grown[-1, -1] = factor, part, math.sqrt(left)
        factor = grown
        kept.append(j)
    return found


def require_full_rank(df: DataFrame, features: str = "features", names: Sequence[str] | None = None) -> None:
    """Fail when a design column is an exact combination of earlier ones, and say of which."""
    size = len(df.select(features).head()[0])
    found = find_aliases(df, list(names) if names is not None else [f"x{i}" for i in range(size)], features)
    if found:
        raise ValueError(f"design has rank {size + 1 - len(found)} of {size + 1}: a term is an exact combination of others: " + "; ".join(map(str, found)))


def pearson_dispersion(df: DataFrame, label: str, fitted: str, parameters: int) -> DataFrame:
    """Pearson chi-squared over residual degrees of freedom, from one aggregate."""
    y, mu = F.col(label).cast("double"), F.col(fitted)
    row = df.agg(
        F.count("*").alias("n"), F.sum(F.pow(y - mu, F.lit(2.0)) / mu).alias("pearson_chi2")
    )
    dof = F.col("n") - F.lit(parameters)
    return row.select(
        "n", dof.alias("residual_dof"), "pearson_chi2", F.try_divide(F.col("pearson_chi2"), dof.cast("double")).alias("dispersion")
    )


def nb_alpha(df: DataFrame, label: str, fitted: str) -> DataFrame:
    """NB2 dispersion: through-origin regression of ``((y-mu)^2 - y)/mu`` on ``mu``."""
    y, mu = F.col(label).cast("double"), F.col(fitted).cast("double")
    auxiliary = (F.pow(y - mu, F.lit(2.0)) - y) / mu
    return df.agg(
        F.try_divide(F.sum(auxiliary * mu), F.sum(mu * mu)).alias("alpha"), F.count("*").alias("n")
    )


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for positive arguments, by Stirling's series.

    The argument is raised by ten first, where the series is good to about twelve digits, and
    the ten factors are divided out again.
    """
    z = x + 10.0
    product = x
    for k in range(1, 10):
        product = product * (x + float(k))
    inverse = F.lit(1.0) / z
    square = inverse * inverse
    tail = inverse * (
        F.lit(1 / 12) - square * (F.lit(1 / 360) - square * (F.lit(1 / 1260) - square * F.lit(1 / 1680)))
    )
    half_log_two_pi = F.lit(0.5 * math.log(2 * math.pi))
    return (z - 0.5) * F.ln(z) - z + half_log_two_pi + tail - F.ln(product)


def count_log_likelihoods(
    df: DataFrame, label: str, poisson_mu: str, nb_mu: str, alpha: float
) -> DataFrame:
    """In-sample log-likelihood of both count models in one aggregate."""
    y = F.col(label).cast("double")
    shape = F.lit(1.0 / alpha)
    mu_p, mu_n = F.col(poisson_mu), F.col(nb_mu)
    factorial = log_gamma(y + 1.0)
    rising = log_gamma(y + shape) - F.lit(math.lgamma(1.0 / alpha))
    spread = mu_n * alpha
    return df.agg(
        F.sum(y * F.ln(mu_p) - mu_p - factorial).alias("poisson_llf"),
        F.sum(rising - factorial + y * F.ln(spread / (1 + spread)) - shape * F.ln(1 + spread)).alias(
            "nb_llf"
        ),
    )


@dataclass(frozen=True)
class LogLinear:
    """Coefficients of a fitted log-link model, applied as a dot product in Spark ML."""

    coefficients: tuple[float, ...]
    intercept: float
    iterations: int = 0
    converged: bool = True

    def predict(self, df: DataFrame, name: str, features: str = "features") -> DataFrame:
        return df.select("*", self.mean(features).alias(name))

    def mean(self, features: str = "features") -> Column:
        weights = F.array(*[F.lit(float(b)) for b in self.coefficients])
        eta = F.aggregate(
            F.zip_with(vector_to_array(features), weights, lambda x, b: x * b),
            F.lit(float(self.intercept)),
            lambda acc, t: acc + t,
        )
        return F.exp(eta)


def fit_negative_binomial(
    df: DataFrame,
    label: str,
    alpha: float,
    start: LogLinear,
    features: str = "features",
    tolerance: float = 1e-8,
    max_iterations: int = 50,
) -> LogLinear:
    """NB2 GLM at a fixed alpha by iteratively reweighted least squares.

    Each step is one distributed weighted least-squares fit. A step's input is the stored rows
    and a coefficient vector, so no plan grows from step to step.
    """
    alpha = max(alpha, 1e-6)
    rows = df.select(F.col(label).cast("double").alias("_y"), features).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    solver = LinearRegression(
        featuresCol=features, labelCol="_z", weightCol="_w", solver="normal", regParam=0.0
    )
    current, done = start, False
    step = 0
    try:
        while step < max_iterations and not done:
            step += 1
            mu = F.greatest(current.mean(features), F.lit(1e-12))
            working = rows.select(features, "_y", mu.alias("_mu")).select(
                features,
                (F.ln("_mu") + (F.col("_y") - F.col("_mu")) / F.col("_mu")).alias("_z"),
                (F.col("_mu") / (1 + F.lit(alpha) * F.col("_mu"))).alias("_w"),
            )
            fitted = solver.fit(working)
            new = np.append(fitted.coefficients.toArray(), fitted.intercept)
            old = np.append(np.array(current.coefficients), current.intercept)
            done = bool(np.all(np.abs(new - old) <= tolerance * (1 + np.abs(old))))
            current = LogLinear(tuple(new[:-1]), float(new[-1]), step, done)
    finally:
        rows.unpersist()
    return current


def from_glm(model) -> LogLinear:
    return LogLinear(tuple(model.coefficients.toArray()), float(model.intercept))


def coefficient_rows(
    names: Sequence[str], model, dispersion: float, z: float = 1.959963984540054
) -> list[tuple]:
    """Coefficient, quasi-Poisson error, p-value and rate ratio with its interval, per term.

    The dispersion multiplies the variance of every coefficient and moves no estimate.
    """
    inflation = math.sqrt(dispersion)
    errors = [e * inflation for e in model.summary.coefficientStandardErrors]
    estimates = [*model.coefficients.toArray(), model.intercept]
    rows = []
    for name, b, e in zip([*names, "Intercept"], estimates, errors, strict=True):
        p = math.erfc(abs(b / e) / math.sqrt(2.0)) if e > 0 else None
        rows.append(
            (
                name,
                float(b),
                float(e),
                p,
                math.exp(b),
                math.exp(b - z * e),
                math.exp(b + z * e),
            )
        )
    return rows


COEFFICIENT_SCHEMA = (
    "term string, coefficient double, std_error double, p_value double, "
    "rate_ratio double, rate_ratio_low double, rate_ratio_high double"
)


def coefficient_table(
    df: DataFrame, names: Sequence[str], model, dispersion: float, undetermined: Sequence[str] = ()
) -> DataFrame:
    """The coefficient rows as a frame, ready to be written beside the model.

    Terms that the design left out as undetermined follow with nulls.
    """
    left_out = [(name, *[None] * 6) for name in undetermined]
    return df.sparkSession.createDataFrame(
        [*coefficient_rows(names, model, dispersion), *left_out], COEFFICIENT_SCHEMA
    )


def quasi_summary(df: DataFrame, label: str, fitted: str, parameters: int) -> DataFrame:
    """Dispersion with the factor it puts on every standard error."""
    return pearson_dispersion(df, label, fitted, parameters).select(
        "*", F.sqrt("dispersion").alias("error_inflation")
    )
