"""The registered tree queries tune over the whole grid."""

from tidegrid.catalog import QUERIES, model_queries
from tidegrid.models.trees import TUNING_GRID
from tidegrid.plans import forecasts


def test_queries_tune_over_every_round(spark, monkeypatch):
    grids = []

    def told(df, features, label, date, cut, grid=TUNING_GRID):
        grids.append(grid)
        return spark.createDataFrame([(1, 0.1, 15, 200, 1, 0.5)], "position int, step_size double, max_leaves int, rounds int, n long, valid_rmse double")

    monkeypatch.setattr(model_queries, "tune_forward", told)
    monkeypatch.setattr(forecasts, "value_rows", lambda spark, sf_dir: (None, None))
    monkeypatch.setattr(model_queries, "_made", {})
    QUERIES["gbt_tuned"](spark, "none")
    assert [tuple(g) for g in grids] == [TUNING_GRID]
    assert [g["rounds"] for g in grids[0]] == [300, 300, 600, 200, 200, 200]
