"""Column builders for flags, labels, rates and bins. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def guarded_rate(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` where the denominator is positive, else null."""
    den = as_column(denominator)
    return F.when(den > 0, as_column(numerator) / den)


def flag_missing(column: Column | str, sentinels: Sequence = ()) -> Column:
    """True for null and for any sentinel that means "not recorded"; never null."""
    col = as_column(column)
    if not sentinels:
        return col.isNull()
    return col.isNull() | F.coalesce(col.isin(list(sentinels)), F.lit(False))


def flag_equals(column: Column | str, value) -> Column:
    """Equality that reads null as False."""
    return F.coalesce(as_column(column) == F.lit(value), F.lit(False))


def label_case(
    column: Column | str, labels: Mapping[str, Sequence], default: str | None = None
) -> Column:
    """Label by the first listed group of codes that contains the value."""
    col = as_column(column)
    case = None
    for label, codes in labels.items():
        hit = col.isin(list(codes))
        case = F.when(hit, F.lit(label)) if case is None else case.when(hit, F.lit(label))
    if case is None:
        return F.lit(default)
    return case.otherwise(F.lit(default))


def first_label(cases: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """Label of the first condition that holds."""
    out = F.lit(default)
    for label, condition in reversed(list(cases)):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def in_wrapped_range(hour: Column | str, start: int, end: int) -> Column:
    """Membership of a half-open clock range that may wrap past midnight."""
    col = as_column(hour)
    if start <= end:
        return (col >= start) & (col < end)
    return (col >= start) | (col < end)


def bin_floor(column: Column | str, width: float) -> Column:
    """Lower edge of the fixed-width bin holding the value."""
    return F.floor(as_column(column) / F.lit(width)) * F.lit(width)


def masked(condition: Column, value: Column | str) -> Column:
    """The value where the condition holds, null elsewhere (including a null condition)."""
    return F.when(condition, as_column(value))


def share(condition: Column, known: Column | None = None) -> Column:
    """Aggregate: share of rows meeting the condition, over rows where it is known."""
    if known is None:
        return F.avg(F.when(condition, 1.0).otherwise(0.0))
    return F.avg(F.when(known & condition, 1.0).when(known, 0.0))


def tally(condition: Column) -> Column:
    """Aggregate: number of rows meeting the condition, 0 rather than null when none do."""
    return F.count(F.when(condition, 1))


def between_half_open(column: Column | str, start, end) -> Column:
    """``start <= column < end``."""
    col = as_column(column)
    return (col >= start) & (col < end)


def cyclical(column: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the value as an angle, so both ends of the period touch."""
    angle = as_column(column) * F.lit(2.0) * F.pi() / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
