"""Search of names with spelling mistakes (R02): a posting table of trigrams, then the edit distance.

A name is framed by two marks on either side, so that it has two trigrams more than letters.  One
edit destroys at most three of them: of any ``3 k + 1`` trigrams of a query, a name within ``k``
edits has at least one.  So the rarest such trigrams of each query are joined with the postings, and
the edit distance is taken of what is met.  A query of fewer trigrams meets all names of nearly its
length.  No name within the distance is missed, and frequent trigrams are hardly ever joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDGE_LEFT, EDGE_RIGHT = "\x01\x01", "\x02\x02"


def trigrams(name: Column) -> Column:
    framed = F.concat(F.lit(EDGE_LEFT), name, F.lit(EDGE_RIGHT))
    return F.transform(F.sequence(F.lit(1), F.char_length(name) + 2), lambda i: F.substring(framed, i, F.lit(3)))


def postings(names: DataFrame, column: str) -> DataFrame:
    """(gram, name): every distinct name, in lower case, under each of its trigrams."""
    distinct = names.select(F.lower(F.col(column)).alias("name")).where("name IS NOT NULL").distinct()
    return distinct.select("name", F.explode(F.array_distinct(trigrams(F.col("name")))).alias("gram"))


def candidates(names: DataFrame, column: str, queries: DataFrame, distance: int) -> DataFrame:
    """(query, name), both in lower case: at least the pairs within ``distance`` edits."""
    listed = postings(names, column)
    frequency = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    asked = queries.select(F.lower(F.col("query")).alias("query")).where("query IS NOT NULL").distinct()
    need = 3 * distance + 1
    grams = (asked.select("query", F.explode(trigrams(F.col("query"))).alias("gram"))
             .groupBy("query", "gram").agg(F.count(F.lit(1)).alias("times")).join(frequency, "gram", "left"))
    # A window holds the trigrams of one query.
    rarest = Window.partitionBy("query").orderBy(F.coalesce("names", F.lit(0)), "gram").rowsBetween(Window.unboundedPreceding, -1)
    probes = grams.withColumn("before", F.coalesce(F.sum("times").over(rarest), F.lit(0))).where(F.col("before") < need)
    met = probes.join(listed, "gram").select("query", "name")
    size = F.char_length("query")
    short = asked.where(size + 2 < need).select(
        "query", F.explode(F.sequence(F.greatest(size - distance, F.lit(0)), size + distance)).alias("length"))
    by_length = names.select(F.lower(F.col(column)).alias("name")).where("name IS NOT NULL").distinct().withColumn(
        "length", F.char_length("name")).where(F.col("length") + 2 < need + distance)
    return met.unionByName(short.join(by_length, "length").select("query", "name")).distinct()


def fuzzy_search(names: DataFrame, column: str, queries: DataFrame, distance: int = 2) -> DataFrame:
    """The rows of ``names`` whose ``column`` is within ``distance`` edits of a query, ignoring case,
    with ``query`` (in lower case) and ``distance``."""
    pairs = candidates(names, column, queries, distance).withColumn("distance", F.levenshtein("query", "name")).where(
        F.col("distance") <= distance)
    rows = names.withColumn("__name", F.lower(F.col(column)))
    return rows.join(pairs.withColumnRenamed("name", "__name"), "__name").drop("__name")
