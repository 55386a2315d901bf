"""Predicates shared by validation and data-quality checks."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F


def present(column: Column) -> Column:
    """Neither NULL nor the empty text; blanks and ``0`` count as present."""
    return F.coalesce(column != "", F.lit(False))


def any_null(columns: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def outside(column: Column, low: float | None = None, high: float | None = None,
            nan_violates: bool = False) -> Column:
    """Value below ``low`` or above ``high``; both bounds are inclusive and NULL is never outside.

    Spark sorts NaN above every number, so it is treated on its own: warehouse SQL finds NaN
    neither below nor above a bound, a negated range test (``NOT x >= low``) does flag it.
    """
    if low is None and high is None:
        raise ValueError("give at least one bound")
    nan = F.isnan(column.cast("double"))
    sides = []
    if low is not None:
        sides.append(column < low)
    if high is not None:
        sides.append(column > high)
    beyond = reduce(or_, sides)
    return (beyond | nan) if nan_violates else (beyond & ~nan)
