"""Registered queries against their SQL on the smallest tables.

A spread of queries runs by default; TIDEGRID_ALL=1 runs every one.
"""

import importlib.util
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(ROOT))

from tidegrid.catalog import ORACLES, QUERIES  # noqa: E402

SPREAD = (
    "entity_hour_grid entity_hour_measures rule_waterfall rules_applied missing_profile join_audit dim_rollup "
    "lag_verified clock_keys scheduled_realised dst_collapse harmonised_union coverage stable_sample "
    "resolved_with_source site_spread lagged_outcomes holidays null_audit invariants distribution extremes modes "
    "rank_gap matched_compare event_day zone_table comparison bias_by_bin attributed_bias imputed glm_cell_means"
).split()
NAMES = sorted(QUERIES) if os.environ.get("TIDEGRID_ALL") else SPREAD


def _checker():
    spec = importlib.util.spec_from_file_location("check_oracles", ROOT / "tools" / "check_oracles.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def tables():
    return _checker().connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, tables, name):
    ok, note, _ = _checker().compare(spark, tables, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, note


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 140


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 3600
    assert set(contract.oracle_sql()) <= set(contract.queries())
