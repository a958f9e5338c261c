"""Rates of rare domains reach the optimum with the defaults that the queries use."""

import numpy as np
import pytest

from tidegrid.llm.mixing import fit_rates


@pytest.mark.parametrize("rare", [0.002, 0.0005])
def test_rates_of_a_rare_domain_are_the_best(spark, rare):
    tokens = {(1.0, 0.0, 0.0): 1.0 - 0.12 - rare, (0.0, 1.0, 0.0): 0.12, (0.0, 0.0, 1.0): rare}
    rows = [(list(p), round(t * 1_000_000), 1) for p, t in tokens.items()]
    targets = [0.90, 0.05, 0.05]
    members = spark.createDataFrame(rows, "mix_p array<double>, mix_tokens long, mix_copies long")
    got = {tuple(r["mix_p"]): r["mix_rate"] for r in fit_rates(members, targets).collect()}
    # with hard posteriors each domain stands alone: (w rate - target) + ridge (rate - 1) = 0
    for (p, w), target in zip(tokens.items(), targets, strict=True):
        assert got[p] == pytest.approx((target + 0.001) / (w + 0.001), rel=1e-6)
    assert got[0.0, 0.0, 1.0] * rare == pytest.approx(0.034 if rare == 0.002 else 0.017, abs=1e-9)


def test_no_rate_falls_below_zero(spark):
    random = np.random.default_rng(4)
    p = np.round(random.dirichlet([0.3, 0.3, 0.02], 200), 3)
    p, t = np.unique(p, axis=0), np.arange(1.0, len(np.unique(p, axis=0)) + 1)
    members = spark.createDataFrame([(a.tolist(), int(n), 1) for a, n in zip(p, t)], "mix_p array<double>, mix_tokens long, mix_copies long")
    targets = np.array([0.05, 0.05, 0.90])
    got = {tuple(r["mix_p"]): r["mix_rate"] for r in fit_rates(members, targets.tolist()).collect()}
    rate = np.array([got[tuple(a)] for a in p.tolist()])
    pull = p @ (p.T @ (rate * t) / t.sum() - targets) + 0.001 * (rate - 1)
    assert rate.min() == 0 and np.abs(np.where(rate > 0, pull, np.minimum(pull, 0))).max() < 1e-8


def dual(p, t, targets, ridge=0.001):
    """The same optimum by Newton steps on one residual a domain."""
    w, pulls = t / t.sum(), np.zeros(len(targets))
    for _ in range(200):
        rate = np.maximum(0, 1 - p @ pulls / ridge)
        slope = pulls + targets - p.T @ (w * rate)
        if np.abs(slope).max() < 1e-13:
            break
        held = w * (rate > 0)
        pulls = pulls - 0.5 * np.linalg.solve(np.eye(len(targets)) + p.T @ (p * held[:, None]) / ridge, slope)
    return rate


@pytest.mark.parametrize("seed", [1, 2])
def test_projected_gradient_ends_where_the_dual_does(spark, seed):
    random = np.random.default_rng(seed)
    p = np.unique(np.round(random.dirichlet(random.uniform(0.05, 0.5, 4), 300), 3), axis=0)
    t, targets = np.arange(1.0, len(p) + 1), random.dirichlet([1] * 4)
    members = spark.createDataFrame([(a.tolist(), int(n), 1) for a, n in zip(p, t)], "mix_p array<double>, mix_tokens long, mix_copies long")
    got = {tuple(r["mix_p"]): r["mix_rate"] for r in fit_rates(members, targets.tolist()).collect()}
    assert np.allclose([got[tuple(a)] for a in p.tolist()], dual(p, t, targets), atol=1e-5)


def test_bounded_rates_thin_what_is_over_its_target_and_repeat_nothing(spark):
    members = spark.createDataFrame([([1.0, 0.0], 800, 1), ([0.0, 1.0], 200, 1)], "mix_p array<double>, mix_tokens long, mix_copies long")
    got = {tuple(r["mix_p"]): r["mix_rate"] for r in fit_rates(members, [0.95, 0.05], most=1.0).collect()}
    assert got[1.0, 0.0] == 1.0 and got[0.0, 1.0] == pytest.approx((0.05 + 0.001) / (0.2 + 0.001), rel=1e-6)
