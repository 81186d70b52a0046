"""Joins that bring tables of different grain and key onto one spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.grain import Grain


def join_exact(spine: DataFrame, other: DataFrame, on: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Left join on equal keys and date (J03); on ``("date",)`` for date-only tables."""
    return spine.join(other, list(on), "left")


def join_period(
    spine: DataFrame, other: DataFrame, grain: Grain, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Left join on the period both dates fall into.

    Rolled-up rows carry the period start, native coarse rows usually its end;
    comparing ``trunc(date)`` makes them meet.  ``other`` must be unique per period.
    """
    left = spine.withColumn("__period", grain.period_start("date"))
    right = other.withColumn("__period", grain.period_start("date")).drop("date")
    return left.join(right, [*keys, "__period"], "left").drop("__period")


def join_snapshot(spine: DataFrame, other: DataFrame) -> DataFrame:
    """Left join on the symbol alone.

    No broadcast hint: Catalyst and AQE broadcast by measured size only.
    """
    return spine.join(other, "symbol", "left")


def membership_flag(df: DataFrame, members: DataFrame, name: str) -> DataFrame:
    """1 where the symbol is a member, else 0."""
    wanted = members.select("symbol").distinct().withColumn("__member", F.lit(1))
    return (
        df.join(wanted, "symbol", "left")
        .withColumn(name, F.coalesce("__member", F.lit(0)).cast("int"))
        .drop("__member")
    )
