"""Every registered query with the SQL it must agree with."""

from __future__ import annotations

from tidegrid.catalog.registry import ORACLES, QUERIES
from tidegrid.catalog import (  # noqa: F401  (imported to register)
    grid_queries,
    rule_queries,
    join_queries,
    clock_queries,
    source_queries,
    gap_queries,
    history_queries,
    contract_queries,
    profile_queries,
    compare_queries,
    evaluate_queries,
    model_queries,
)

__all__ = ["ORACLES", "QUERIES"]
