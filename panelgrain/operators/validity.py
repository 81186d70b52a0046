"""Validity intervals (R20): changes become intervals, and rows meet the interval that holds their day.

Intervals are cut at the years they span, so that rows and intervals join on (symbol, year) by
equality; the days are then compared.  A pair of symbol and year has at most 366 intervals, however
many changes there are, and AQE can split the rows of a busy one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def validity(changes: DataFrame, value: str, order: Sequence[str] = (), on: str = "symbol", date: str = "date") -> DataFrame:
    """(symbol, valid_from, valid_to, value): from a change's day to the day before the next one's.

    Of several changes on a day the last by ``order`` counts (without ``order``: the greatest value);
    the last interval of a symbol is open (``valid_to`` null).  Changes without a day are dropped.
    """
    last = F.struct(*[F.col(c) for c in order], F.col(value).alias("__value"))
    daily = changes.where(F.col(date).isNotNull()).groupBy(on, F.col(date).cast("date").alias("valid_from")).agg(F.max(last).alias("__last"))
    after = F.lead("valid_from").over(Window.partitionBy(on).orderBy("valid_from"))
    return daily.select(on, "valid_from", F.date_sub(after, 1).alias("valid_to"), F.col("__last.__value").alias(value))


def join_valid(rows: DataFrame, intervals: DataFrame, value: str, on: str = "symbol", date: str = "date") -> DataFrame:
    """``rows`` with ``value`` of the interval that holds their day; null where none does."""
    year = F.year(F.col(date).cast("date"))
    last = rows.agg(F.max(year)).scalar()
    until = F.coalesce(F.year("valid_to"), F.greatest(last, F.year("valid_from")))
    cut = intervals.select(
        F.col(on).alias("__on"), "valid_from", "valid_to", F.col(value).alias("__value"),
        F.explode(F.sequence(F.year("valid_from"), until)).alias("__year"))
    keyed = rows.withColumn("__row_year", year)
    holds = (F.col(date).cast("date") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(date).cast("date") <= F.col("valid_to")))
    joined = keyed.join(cut, (F.col(on) == F.col("__on")) & (F.col("__row_year") == F.col("__year")) & holds, "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.col("__value").alias(value))
