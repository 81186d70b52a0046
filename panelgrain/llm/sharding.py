"""Sharding: a keyed pseudo-random permutation of global row numbers.

Rows get dense numbers that depend on the data alone, not on files or partitions; a Feistel network
over a square domain with cycle walking permutes them; shard and slot are the remainder and the
quotient of the permuted number, so they can be computed from the row number and back.

Defined results: a null text has no bytes (size 8, checksum 0); rows that agree in id, size and
checksum are interchangeable and get consecutive numbers; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, table

ROUNDS = 6


def numbered(rows: DataFrame, buckets: int = 4096) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` 0..N-1 in the order of (bucket, columns), and N.

    Equal rows are counted before the shuffle and take a range of numbers; what is sorted is one
    of ``buckets`` hash buckets of distinct rows.  Only the bucket totals reach the driver.
    """
    keys = rows.columns
    counted = settled(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
                      .withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
    totals = dict(counted.groupBy("bucket").agg(F.sum("copies")).collect())
    begins, n = [], 0
    for b in range(buckets):
        begins.append(n)
        n += totals.get(b, 0)
    offsets = F.split(F.lit(",".join(map(str, begins))), ",").cast("array<bigint>")
    upto = F.sum("copies").over(Window.partitionBy("bucket").orderBy(*keys)
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = offsets[F.col("bucket")] + upto - F.col("copies")
    return (counted.withColumn("first", first)
            .select(*keys, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("row_number")),
            n)


def permuted(number, n: int, seed: int = 7):
    """The Feistel image of ``number`` among 0..n-1 (n > 0); a bijection for every n.

    The domain is the smallest square of at least n.  Images outside 0..n-1 are sent through the
    network again.  At most 2*sqrt(n)+1 places lie outside, so every cycle is back inside within
    the steps below except with a chance under 1e-15; should it not be, the query fails.
    """
    side = math.isqrt(n - 1) + 1
    outside = side * side - n

    def step(x):
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            F.struct(F.call_function("div", x, F.lit(side)).alias("l"), F.pmod(x, F.lit(side)).cast("long").alias("r")),
            lambda s, k: F.struct(
                s["r"].alias("l"),
                F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(seed), k, s["r"]), F.lit(side)), F.lit(side)).cast("long").alias("r")),
            lambda s: s["l"] * F.lit(side) + s["r"])

    walked = step(number)
    if outside:
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(min(outside, 64))), walked,
            lambda x, _: F.when(x < n, x).otherwise(step(x)))
        walked = F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))
    return walked


def shard(rows: DataFrame, shards: int = 24, seed: int = 7, buckets: int = 4096) -> DataFrame:
    """``rows`` with row_number, position, shard (sizes at most one apart) and gapless slot.

    ``rows`` must be orderable columns; hand in ids and digests and join texts back by them.
    """
    out, n = numbered(rows, buckets)
    out = out.withColumn("position", permuted(F.col("row_number"), max(n, 1), seed))
    return out.withColumns({
        "shard": F.pmod("position", F.lit(shards)).cast("int"),
        "slot": F.floor(F.col("position") / F.lit(shards)).cast("long")})


def op8_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
