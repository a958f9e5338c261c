"""Count fits on rows whose conditions cannot be told apart in training."""

import math

import numpy as np
import pandas as pd
import pytest

from tidegrid.catalog import QUERIES, model_queries
from tidegrid.models.counts import design_rank
from tidegrid.plans import forecasts
from tidegrid.plans.study import ENTITIES


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Readings that stay below the cold limit: every wet hour is a freezing one."""
    rng = np.random.default_rng(5)
    n = 80_000
    events = pd.DataFrame(
        {
            "event_id": np.arange(n),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 30 * 86_400, n), unit="s"),
            "user_id": rng.integers(0, 500, n),
            "event_type": rng.choice(ENTITIES, n),
            "value": rng.uniform(1.0, 80.0, n).round(2),
            "props": [f'{{"k": {k}}}' for k in rng.integers(0, 100, n)],
        }
    )
    at = tmp_path_factory.mktemp("events")
    events.to_parquet(at / "events.parquet", coerce_timestamps="us")
    return str(at)


def test_a_condition_that_repeats_another_is_left_out_of_the_fits(spark, folder, monkeypatch):
    monkeypatch.setattr(model_queries, "_made", {})
    fits = forecasts.fit_counts(spark, folder)
    study = fits.study
    assert [(a.column, [name for name, _ in a.parts]) for a in study.aliases] == [("is_freezing", ["is_wet"])]
    assert "is_wet" in study.design.names and "is_freezing" not in study.design.names
    columns, rank = design_rank(study.train)
    assert columns == rank == len(study.design.names) + 1 and fits.negative_binomial.converged
    assert study.train.count() == 14 * 24 * 5 and study.test.count() == 9 * 24 * 5
    monkeypatch.setattr(forecasts, "fit_counts", lambda *_: fits)
    table = {r["term"]: r for r in QUERIES["coefficient_table"](spark, folder).collect()}
    assert set(table) == {*study.design.names, "Intercept", "is_freezing"}
    assert table["is_freezing"][1:] == (None,) * 6
    assert all(math.isfinite(r["std_error"]) for name, r in table.items() if name != "is_freezing")
