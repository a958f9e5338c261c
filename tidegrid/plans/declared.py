"""What a plan says about the columns it adds; manifests are collected from these sayings."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Declared:
    """A column with its role and, where they apply, feature group, reason for nulls and filling.

    ``kind`` is number, flag or level. ``made_of`` names columns that it is an exact linear
    combination of, so that a linear design must leave it out.
    """

    name: str
    role: str = "feature"
    group: str = ""
    null: str = ""
    fill: str = ""
    kind: str = "number"
    made_of: tuple[str, ...] = ()

    def lagged(self, hours: int, group: str) -> Declared:
        """The same outcome some hours earlier: now a feature, empty before the first lag, then filled with 0."""
        return replace(
            self, name=f"{self.name}_lag_{hours}h", role="feature", group=group, null=self.null or "before the first lag", fill="zero"
        )


def feature_groups(columns: Iterable[Declared]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for c in columns:
        if c.role == "feature":
            out.setdefault(c.group, []).append(c.name)
    return out


def roles(columns: Iterable[Declared]) -> dict[str, list[str]]:
    """Columns by role, without the features."""
    out: dict[str, list[str]] = {}
    for c in columns:
        if c.role != "feature":
            out.setdefault(c.role, []).append(c.name)
    return out


def null_reasons(columns: Iterable[Declared]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for c in columns:
        if c.null:
            out.setdefault(c.null, []).append(c.name)
    return out


def filled(columns: Iterable[Declared], how: str) -> list[str]:
    return [c.name for c in columns if c.role == "feature" and c.fill == how]


def features(columns: Iterable[Declared], *kinds: str) -> list[Declared]:
    """Features of the kinds, each name once."""
    found = {c.name: c for c in columns if c.role == "feature" and c.kind in kinds}
    return list(found.values())


def require_no_leaks(columns: Iterable[Declared], leaking: str = "leak_if_unlagged") -> None:
    """Fail when a column is declared both a feature and an outcome of the same hour."""
    columns = list(columns)
    outcomes = {c.name for c in columns if c.role == leaking}
    both = sorted(c.name for c in columns if c.role == "feature" and c.name in outcomes)
    if both:
        raise ValueError(f"outcomes of the same hour among the features: {both}")
