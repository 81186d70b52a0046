"""Groups of symbols on one date: sector performance, sector P/E, peer statistics.

Group statistics are partial aggregates joined back by (date, sector); no window
ever holds a whole sector, however large one sector is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ratio
from ..plans.session import settled


def group_performance(df: DataFrame, change: str, group: Sequence[str] = ("date", "sector")) -> DataFrame:
    """Average change and number of symbols per group."""
    return df.groupBy(*group).agg(
        F.avg(change).alias("average_change"), F.count(change).alias("symbols")
    )


def group_pe(
    df: DataFrame, cap: str, income: str, group: Sequence[str] = ("date", "sector")
) -> DataFrame:
    """Aggregate price/earnings: total capitalisation over total income."""
    return df.groupBy(*group).agg(ratio(F.sum(cap), F.sum(income)).alias("pe"))


def peer_statistics(
    df: DataFrame, value: str, group: Sequence[str] = ("date", "sector")
) -> DataFrame:
    """Each row's z-score, percentile rank and distance to the group median.

    The exact percentile rank (rows below / (rows − 1)) is counted on distinct values: these are
    counted, dealt by sorted ranges of (group, value), which cut a large group wherever the data
    ask for it, and running counts are taken over a group's ranges and inside each range.  The exact
    median is the value or pair of values whose counts cover the middle row.  NULL and NaN are
    missing: they are no peers and get NULL.

    The rows are written once to the shared folder, and so are the counts: both are read twice, and
    what they were computed from (a panel's scans and joins) is not planned or run again.
    """
    keys = list(group)
    v, c = F.col(value), F.col("__c")
    rows = settled(df)
    counts = rows.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    dealt = settled(counts.repartitionByRange(*keys, value).withColumn("__range", F.spark_partition_id()))
    of_group = Window.partitionBy(*keys)
    before = of_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(*keys, "__range").agg(F.sum(c).alias("__here"), F.sum(v * c).alias("__sum"))
    ranges = ranges.select(
        *keys, "__range",
        F.coalesce(F.sum("__here").over(before), F.lit(0)).alias("__ahead"),
        F.sum("__here").over(of_group).alias("__n"),
        ratio(F.sum("__sum").over(of_group), F.sum("__here").over(of_group)).alias("__mean"),
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = dealt.join(ranges, [*keys, "__range"]).select(
        *keys, value, "__c", "__n", "__mean",
        (F.col("__ahead") + F.coalesce(F.sum("__c").over(inside), F.lit(0))).alias("__below"),
    )

    def at(position):
        covered = (F.col("__below") <= position) & (position < F.col("__below") + c)
        return F.max(F.when(covered, v))

    half = (F.col("__n") - 1) / 2
    peers = below.groupBy(*keys).agg(
        ((at(F.floor(half)) + at(F.ceil(half))) / 2).alias("peer_median"),
        F.max("__mean").alias("__peer_mean"),
        F.sqrt(ratio(F.sum(c * F.pow(v - F.col("__mean"), 2)), F.max("__n") - 1)).alias("__peer_sd"),
        F.max("__n").alias("__peers"),
    )
    joined = rows.join(peers, keys, "left").join(
        below.select(*keys, value, "__below"), [*keys, value], "left"
    )
    return joined.select(
        *df.columns,
        "peer_median",
        (v - F.col("peer_median")).alias("to_peer_median"),
        ratio(v - F.col("__peer_mean"), F.col("__peer_sd")).alias("peer_z"),
        ratio(F.col("__below"), F.col("__peers") - 1).alias("peer_percentile"),
    )
