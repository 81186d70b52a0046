"""Screening, search and ranking of symbols."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def screen(
    df: DataFrame,
    at_least: Mapping[str, float] | None = None,
    at_most: Mapping[str, float] | None = None,
    equal: Mapping[str, object] | None = None,
    order_by: Sequence[str | Column] | None = None,
    limit: int | None = None,
    page: int = 0,
) -> DataFrame:
    """Bounds and equalities on any columns; ``limit``/``page`` only when asked for."""
    for name, bound in (at_least or {}).items():
        df = df.filter(F.col(name) >= bound)
    for name, bound in (at_most or {}).items():
        df = df.filter(F.col(name) <= bound)
    for name, value in (equal or {}).items():
        df = df.filter(F.col(name) == value)
    if order_by:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.offset(page * limit).limit(limit)
    return df


def search(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any column contains ``text``, ignoring case, with the edit distance."""
    wanted = text.lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(wanted)), F.lit(False))
    nearest = F.least(*[F.levenshtein(F.lower(F.col(c)), F.lit(wanted)) for c in columns]) \
        if len(columns) > 1 else F.levenshtein(F.lower(F.col(columns[0])), F.lit(wanted))
    return df.filter(hit).withColumn("distance", nearest)


def movers(
    df: DataFrame,
    lists: Mapping[str, tuple[str, bool]],
    k: int,
    per: Sequence[str] = ("date",),
    tie: Sequence[str] = ("symbol",),
) -> DataFrame:
    """Top ``k`` per day for several lists, each ``name: (measure, largest first)``.

    A row becomes one candidate per list, so the input is read and shuffled once;
    ``row_number() <= k`` lets Spark drop all but k candidates per day, list and
    partition before that shuffle, so a busy day does not pile up in one task.
    """
    candidates = F.array(*[
        F.struct(
            F.lit(name).alias("list"),
            (F.col(by) if largest else -F.col(by)).cast("double").alias("__score"),
        )
        for name, (by, largest) in lists.items()
    ])
    spread = df.select("*", F.inline(candidates)).filter(F.col("__score").isNotNull())
    w = Window.partitionBy(*per, "list").orderBy(F.col("__score").desc(), *tie)
    ranked = spread.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k).drop("__score")
