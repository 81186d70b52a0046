"""Operators on statement tables and trade records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import by_symbol, growth, ratio
from .asof import carry_forward_rows


def trailing_sums(df: DataFrame, columns: Sequence[str], rows: int = 4, prefix: str = "ttm_") -> DataFrame:
    """Sums over the last ``rows`` periods, NULL until there are that many."""
    frame = by_symbol().rowsBetween(-(rows - 1), 0)
    full = F.row_number().over(by_symbol()) >= rows
    return df.select(
        "symbol", "date",
        *[F.when(full, F.sum(c).over(frame)).alias(prefix + c) for c in columns],
    )


def growth_table(df: DataFrame, columns: Sequence[str], k: int = 1, prefix: str = "growth_") -> DataFrame:
    """Growth of each column against the row ``k`` periods earlier."""
    return df.select(
        "symbol", "date",
        *[growth(F.col(c), F.lag(c, k).over(by_symbol())).alias(prefix + c) for c in columns],
    )


def insider_statistics(trades: DataFrame) -> DataFrame:
    """Bought and sold trades per symbol and quarter."""
    bought = F.col("acquisition_or_disposition") == "A"
    sold = F.col("acquisition_or_disposition") == "D"
    shares = F.col("securities_transacted")
    out = trades.groupBy(
        "symbol", F.year("date").alias("year"), F.quarter("date").alias("quarter")
    ).agg(
        F.count_if(bought).alias("acquired_trades"),
        F.count_if(sold).alias("disposed_trades"),
        F.coalesce(F.sum(F.when(bought, shares)), F.lit(0)).alias("acquired_shares"),
        F.coalesce(F.sum(F.when(sold, shares)), F.lit(0)).alias("disposed_shares"),
    )
    return out.withColumn(
        "acquired_disposed_ratio", ratio(F.col("acquired_trades"), F.col("disposed_trades"))
    )


def member_on_date(rows: DataFrame, changes: DataFrame, name: str = "is_member") -> DataFrame:
    """Point-in-time membership (R20): the newest add/remove not after the row's date decides.

    ``changes`` holds (symbol, date, added BOOLEAN), one row per symbol and date.
    """
    carried = carry_forward_rows(rows, [(changes, ["added"])])
    return carried.withColumn(name, F.coalesce(F.col("added"), F.lit(False)).cast("int")).drop("added")
