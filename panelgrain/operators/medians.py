"""Exact medians of groups of any size.

Spark's median keeps a group's values in one buffer.  Here values are counted, dealt by sorted
ranges of (keys, value), and only the one or two ranges of a group that hold its middle are looked
into; the others are known by their counts.  A group of any size is spread over as many tasks as
its distinct values need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import settled


def medians(df: DataFrame, value: str, keys: Sequence[str] = ("symbol",), name: str = "median") -> DataFrame:
    """(keys, name): the exact median as a DOUBLE; null and NaN values do not count, and a group of
    nothing else has no row.  Of an even number of values it is the mean of the middle two."""
    number = F.col(value).cast("double")
    counted = (df.select(*keys, number.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
               .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")))
    dealt = settled(counted.repartitionByRange(*keys, "__v").withColumn("__range", F.spark_partition_id()))
    here = dealt.groupBy(*keys, "__range").agg(F.sum("__n").alias("__here"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = here.select(*keys, "__range", (F.sum("__here").over(upto) - F.col("__here")).alias("__before"), "__here",
                         F.sum("__here").over(group).alias("__total"))
    low, high = F.call_function("div", F.col("__total") - 1, F.lit(2)), F.call_function("div", F.col("__total"), F.lit(2))
    middle = placed.withColumns({"__low": low, "__high": high}).where(
        (F.col("__before") <= F.col("__high")) & (F.col("__before") + F.col("__here") > F.col("__low")))
    middle = middle.select(F.struct(*keys, "__range").alias("__at"), "__before", "__low", "__high")
    inside = dealt.join(middle, F.struct(*keys, "__range").eqNullSafe(F.col("__at")))
    within = Window.partitionBy(*keys, "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("__end", F.col("__before") + F.sum("__n").over(within)).withColumn("__begin", F.col("__end") - F.col("__n"))

    def at(place):
        return F.max(F.when((F.col("__begin") <= F.col(place)) & (F.col(place) < F.col("__end")), F.col("__v")))
    return ranked.groupBy(*keys).agg(((at("__low") + at("__high")) / 2).alias(name))
