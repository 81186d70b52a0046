"""Column combinators shared by the features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

TRADING_DAYS = 252


def ratio(top: Column, bottom: Column) -> Column:
    """Division as DOUBLE; NULL where the denominator is zero or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def relative(now: Column, base: Column) -> Column:
    """Change relative to a base kept with its sign."""
    return ratio(now - base, base)


def growth(now: Column, before: Column) -> Column:
    """Change relative to the magnitude of the earlier value."""
    return ratio(now - before, F.abs(before))


def compound(now: Column, before: Column, periods: int) -> Column:
    """Growth rate per period that leads from ``before`` to ``now``."""
    return F.pow(ratio(now, before), F.lit(1.0 / periods)) - 1


def flag(condition: Column) -> Column:
    """1 if true, else 0; an unknown condition is 0."""
    return F.when(condition, 1).otherwise(0)


def points(*conditions: Column) -> Column:
    """How many of the conditions hold."""
    return reduce(lambda a, b: a + b, [flag(c) for c in conditions])


def weighted(*terms: tuple[float, Column]) -> Column:
    """Sum of weight × value, left to right; NULL if any value is NULL."""
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * c for w, c in terms])


def per_day(annual: Column) -> Column:
    return annual / F.lit(365.0)


def by_symbol() -> WindowSpec:
    """The window of a panel: one symbol in date order."""
    return Window.partitionBy("symbol").orderBy("date")
