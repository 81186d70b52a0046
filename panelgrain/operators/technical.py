"""Indicators of any length over a price panel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import by_symbol, ratio
from . import recursive as R


ROW = "__row"


def _frame(n: int):
    return by_symbol().rowsBetween(-(n - 1), 0)


def _full(value: Column, n: int) -> Column:
    """NULL until ``n`` rows are there."""
    return F.when(F.row_number().over(by_symbol()) >= n, value)


def sma(n: int) -> Column:
    return _full(F.avg("close").over(_frame(n)), n)


def wma(n: int) -> Column:
    """Linearly weighted mean, newest row heaviest; NULL if a row of the frame lacks its close.

    Row i of the frame that ends at row r weighs n - r + i, so two sums do for any length;
    ``__row`` is the number of each row.
    """
    row, frame = F.col(ROW), _frame(n)
    total = (n - row) * F.sum("close").over(frame) + F.sum(row * F.col("close")).over(frame)
    whole = (row >= n) & (F.count("close").over(frame) == n)
    return F.when(whole, total / F.lit(n * (n + 1) / 2.0))


def standard_deviation(n: int) -> Column:
    return _full(F.stddev_samp("close").over(_frame(n)), n)


def williams(n: int) -> Column:
    """Williams %R, from -100 (close at the low) to 0 (at the high)."""
    high, low = F.max("high").over(_frame(n)), F.min("low").over(_frame(n))
    return _full(ratio(high - F.col("close"), high - low) * -100, n)


WINDOWED = {"sma": sma, "wma": wma, "standard_deviation": standard_deviation, "williams": williams}
RECURSIVE = {
    "ema": R.indicator_ema, "dema": R.indicator_dema, "tema": R.indicator_tema,
    "rsi": R.indicator_rsi, "adx": R.indicator_adx,
}


def with_technical(df: DataFrame, wanted: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add indicators: ``{"rsi_14": ("rsi", 14), ...}``.

    Windowed ones share one window; recursive ones share one grouped map over the
    same partitioning.
    """
    unknown = [k for k, _ in wanted.values() if k not in WINDOWED and k not in RECURSIVE]
    if unknown:
        raise ValueError(f"unknown indicator {unknown[0]!r}")
    flat = {n: WINDOWED[k](p) for n, (k, p) in wanted.items() if k in WINDOWED}
    if flat:
        kept = df.columns
        if any(k == "wma" for k, _ in wanted.values()):
            df = df.withColumn(ROW, F.row_number().over(by_symbol()))
        df = df.select(*kept, *[c.alias(n) for n, c in flat.items()])
    deep = {n: RECURSIVE[k](p) for n, (k, p) in wanted.items() if k in RECURSIVE}
    if deep:
        reads = ["high", "low", "close"] if any(k == "adx" for k, _ in wanted.values()) else ["close"]
        df = R.with_indicators(df, deep, reads)
    return df
