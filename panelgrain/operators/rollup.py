"""Roll-up of a finer table to a coarser grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.grain import Grain


def aggregate(how: str, column: str, order: str = "date") -> Column:
    """Aggregate column by name.

    ``first`` and ``last`` take the value on the smallest and largest date, NULL
    included, as an ordered FIRST/LAST does.
    """
    value = F.col(column)
    if how == "first":
        return F.min_by(value, F.col(order))
    if how == "last":
        return F.max_by(value, F.col(order))
    plain = {"sum": F.sum, "mean": F.avg, "avg": F.avg, "max": F.max, "min": F.min,
             "median": F.median, "count": F.count}
    if how not in plain:
        raise ValueError(f"unknown roll-up {how!r}")
    return plain[how](value)


def roll_up(
    df: DataFrame,
    grain: Grain | str,
    how: Mapping[str, str],
    keys: Sequence[str] = ("symbol",),
    date: str = "date",
) -> DataFrame:
    """One row per key and period; the result date is the period start.

    A single partially aggregated shuffle: each (key, period) group holds at most
    the days of that period once its input is unique per (key, date).
    """
    grain = Grain.parse(grain)
    period = grain.period_start(date)
    aggs = [aggregate(fn, c, date).alias(c) for c, fn in how.items()]
    grouped = df.groupBy(*keys, period.alias("__period"))
    out = grouped.agg(*aggs) if aggs else grouped.agg(F.lit(1).alias("__one")).drop("__one")
    return out.select(*keys, F.col("__period").alias(date), *how)
