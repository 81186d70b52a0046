"""As-of carry-forward (J02): each left row gets the newest right row not after it.

All coarse tables are aligned in ONE pass: the sides are unioned, hash-partitioned
by symbol and scanned in date order, with ``last(..., ignorenulls)`` carrying each
side's row forward.  No fan-out, no range join, one shuffle however many tables.

Both sides are unique per (symbol, date), so a window partition holds at most one
row per side and calendar day: its size is bounded by the calendar and not by the
data.  ``carry_forward_rows`` serves left sides that are *not* unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, Sequence[str]]],
    on: str = "symbol",
    date: str = "date",
    how: str = "left",
) -> DataFrame:
    """Left rows with the carried columns of every right table.

    ``how="inner"`` drops left rows that precede the first row of any right table.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if not rights:
        return left
    left_cols = [c for c in left.columns if c not in (on, date)]
    slots = [f"__r{i}" for i in range(len(rights))]

    # Right rows sort before left rows of the same day, so a same-day match counts.
    sides = left.select(
        F.col(on), F.col(date), F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in left_cols], F.lit(True).alias("__hit")).alias("__l"),
    )
    for slot, (right, cols) in zip(slots, rights):
        row = F.struct(*[F.col(c) for c in cols], F.lit(True).alias("__hit")).alias(slot)
        sides = sides.unionByName(
            right.select(F.col(on), F.col(date), F.lit(0).alias("__side"), row),
            allowMissingColumns=True,
        )
    upto = (
        Window.partitionBy(on).orderBy(date, "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = sides.select(
        on, date, "__side", "__l",
        *[F.last(s, ignorenulls=True).over(upto).alias(s) for s in slots],
    ).filter(F.col("__side") == 1)
    if how == "inner":
        for s in slots:
            carried = carried.filter(F.col(s).isNotNull())
    return carried.select(
        on, date,
        *[F.col(f"__l.{c}").alias(c) for c in left_cols],
        *[F.col(f"{s}.{c}").alias(c) for s, (_, cols) in zip(slots, rights) for c in cols],
    )


def carry_forward_rows(
    left: DataFrame,
    rights: Sequence[tuple[DataFrame, Sequence[str]]],
    on: str = "symbol",
    date: str = "date",
    how: str = "left",
) -> DataFrame:
    """As-of join for event rows, where one symbol may own a large share of the data.

    The distinct (symbol, date) pairs are aligned first — a partially aggregated,
    calendar-bounded set — and the events are then joined to them by equality,
    which AQE can split when a pair is hot.
    """
    points = left.select(on, date).distinct()
    carried = carry_forward(points, rights, on, date, how)
    return left.join(carried, [on, date], how)
