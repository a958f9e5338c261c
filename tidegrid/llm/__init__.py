"""Operators for training-data pipelines; nothing outside this folder imports them."""

from __future__ import annotations

from tidegrid.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
