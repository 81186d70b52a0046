"""Measures of a symbol's returns against themselves and against a reference index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import by_symbol, ratio
from .rolling import Roll, with_rolls


def _step(column: str, k: int = 1) -> Column:
    return ratio(F.col(column), F.lag(column, k).over(by_symbol())) - 1


def _guarded(value: Column, count: Column, least: int) -> Column:
    return F.when(count >= least, value)


def with_autocorrelation(
    df: DataFrame, name: str = "return_autocorrelation_21d", rows: int = 21, least: int = 10
) -> DataFrame:
    """Rolling correlation of the one-row return with its predecessor."""
    r = df.withColumn("__ret", _step("close"))
    r = r.withColumn("__ret_before", F.lag("__ret").over(by_symbol()))
    frame = by_symbol().rowsBetween(-(rows - 1), 0)
    both = F.when(F.col("__ret").isNotNull() & F.col("__ret_before").isNotNull(), 1)
    corr = _guarded(
        F.corr("__ret", "__ret_before").over(frame), F.count(both).over(frame), least
    )
    return r.withColumn(name, corr).drop("__ret", "__ret_before")


def index_returns(index: DataFrame, long: int = 252) -> DataFrame:
    """One-row and ``long``-row returns of one reference series (date, close).

    The series is one row per date, so keying the window by a constant keeps a
    calendar-bounded set in one task.
    """
    one = index.groupBy("date").agg(F.max(F.col("close").cast("double")).alias("close"))
    one = one.select(F.lit("index").alias("symbol"), "date", "close")
    return one.select(
        "date",
        _step("close").alias("__mkt"),
        _step("close", long).alias("__mkt_long"),
    )


def with_beta_alpha(
    df: DataFrame,
    index: DataFrame,
    names: Sequence[str] = ("beta_sp500", "alpha_jensen"),
    rows: int = 252,
    least: int = 60,
) -> DataFrame:
    """Rolling beta and alpha against an index joined on date.

    beta = corr(r, m) · sd(r) / sd(m) over ``rows`` rows, at least ``least`` of each;
    alpha = long return − beta × index long return, with no risk-free term.
    """
    joined = (
        df.withColumn("__ret", _step("close"))
        .withColumn("__ret_long", _step("close", rows))
        # One row per date by construction, so its size is bounded by the calendar.
        .join(F.broadcast(index_returns(index, rows)), "date", "left")
    )
    both, own, market = ("__ret", "__mkt"), ("__ret",), ("__mkt",)
    staged = with_rolls(joined, {
        "__corr": Roll("corr", both, rows),
        "__pairs": Roll("pairs", both, rows),
        "__sd_r": Roll("stddev", own, rows),
        "__n_r": Roll("count", own, rows),
        "__sd_m": Roll("stddev", market, rows),
        "__n_m": Roll("count", market, rows),
    })
    beta = _guarded(
        ratio(F.col("__corr") * F.col("__sd_r"), F.col("__sd_m")),
        F.least("__pairs", "__n_r", "__n_m"),
        least,
    )
    values = {
        "beta_sp500": beta,
        "alpha_jensen": F.col("__ret_long") - beta * F.col("__mkt_long"),
    }
    return staged.select(*df.columns, *[values[n].alias(n) for n in names])


def with_rise_streak(df: DataFrame, column: str, name: str) -> DataFrame:
    """Length of the current run of strict rises; a NULL or a non-rise resets it.

    Row number minus the row number of the latest reset: two passes over one sort.
    """
    upto = by_symbol().rowsBetween(Window.unboundedPreceding, 0)
    rises = F.coalesce(F.col(column) > F.lag(column).over(by_symbol()), F.lit(False))
    marked = df.withColumn("__row", F.row_number().over(by_symbol())).withColumn("__rises", rises)
    reset = F.max(F.when(~F.col("__rises"), F.col("__row"))).over(upto)
    return marked.withColumn(name, (F.col("__row") - reset).cast("bigint")).drop("__row", "__rises")
