"""Guarded arithmetic: NULL stands for missing, never NaN or infinity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def all_present(columns: list[str]) -> Column:
    """No column is NULL.

    One conjunct per column: the optimizer's constraint inference grows with the
    number of conjuncts, but exponentially with computed columns inside a single
    ``na.drop`` predicate.
    """
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def all_finite(columns: list[str]) -> Column:
    """No column is NULL, NaN or infinite."""
    infinity = F.lit(float("inf"))
    checks = [c for name in columns for c in (~F.isnan(name), F.abs(name) != infinity)]
    return reduce(Column.__and__, checks, all_present(columns))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where the bottom is zero."""
    return F.try_divide(top, F.nullif(bottom, F.lit(0.0)))


def percent_change(value: Column, base: Column) -> Column:
    return ratio(value - base, base) * 100


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Limit a value to a range; NULL stays NULL."""
    limited = value
    if low is not None:
        limited = F.greatest(limited, F.lit(low))
    if high is not None:
        limited = F.least(limited, F.lit(high))
    return F.when(value.isNotNull(), limited)
