"""Bars of raw ticks and adjusted prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tick_order(ts: str, tie: str) -> Column:
    """Time, then a row id, as one decimal: open and close stay in a hash aggregate."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    return micros * F.lit("1" + "0" * 19).cast("decimal(20,0)") + F.col(tie).cast("decimal(19,0)")


def bars(
    ticks: DataFrame,
    interval: str,
    ts: str = "ts",
    price: str = "value",
    size: str | None = None,
    tie: str = "event_id",
) -> DataFrame:
    """Open, high, low, close, volume per symbol and interval; batch and streaming alike.

    A partially aggregated group-by: a symbol with very many ticks is combined
    before the shuffle.
    """
    order = tick_order(ts, tie)
    volume = F.count(F.lit(1)) if size is None else F.sum(size)
    grouped = ticks.groupBy("symbol", F.window(ts, interval).alias("__w")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.alias("volume"),
    )
    return grouped.select(
        "symbol", F.col("__w.start").alias("bar_start"), "open", "high", "low", "close", "volume"
    )


def adjust_prices(
    prices: DataFrame, events: DataFrame, factor: Column, columns=("open", "high", "low", "close")
) -> DataFrame:
    """Multiply prices by the factors of all later events.

    ``factor`` is a column of ``events`` (symbol, date, ...): e.g. denominator /
    numerator of a split.  Prices of the event day are already adjusted.
    """
    cols = [c for c in prices.columns if c not in ("symbol", "date")]
    both = prices.select(
        "symbol", "date", F.lit(0).alias("__side"), F.lit(1.0).alias("__factor"),
        F.struct(*cols).alias("__row"),
    ).unionByName(
        events.select(
            "symbol", "date", F.lit(1).alias("__side"), factor.cast("double").alias("__factor")
        ),
        allowMissingColumns=True,
    )
    later = (
        Window.partitionBy("symbol").orderBy(F.col("date").desc(), "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scaled = both.withColumn("__scale", F.product("__factor").over(later)).filter("__side = 0")
    return scaled.select(
        "symbol", "date",
        *[(F.col(f"__row.{c}") * F.col("__scale")).alias(f"adj_{c}") for c in columns if c in cols],
        F.col("__scale").alias("adjustment"),
    )
