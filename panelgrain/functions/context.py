"""How features see a panel, and how their window work is staged.

A feature is a function of a :class:`PanelView` returning a ``Column``.  The view
notes which fields, lags and rolling aggregates are asked for, so that a whole set
of features is evaluated in at most four steps over one (symbol, date) sort:

1. lags            — one column per distinct (field, k)
2. definitions     — row-wise values that a rolling aggregate runs over
3. rolling windows — one column per distinct (aggregate, value, length)
4. the features themselves, row-wise

Equal sub-expressions are thereby computed once, and window functions never nest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rolling import STATISTICS, Roll, with_rolls
from ..sources.grain import Grain

Builder = Callable[["PanelView"], Column]


def skewness_sample(value: Column, window) -> Column:
    """Sample skewness G1 from the population value, NULL below three rows."""
    n = F.count(value).over(window).cast("double")
    g1 = F.skewness(value).over(window)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_sample(value: Column, window) -> Column:
    """Sample excess kurtosis G2 from the population value, NULL below four rows."""
    n = F.count(value).over(window).cast("double")
    g2 = F.kurtosis(value).over(window)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


_OVER = {
    "avg": lambda c, w: F.avg(c).over(w),
    "stddev": lambda c, w: F.stddev_samp(c).over(w),
    "max": lambda c, w: F.max(c).over(w),
    "min": lambda c, w: F.min(c).over(w),
    "sum": lambda c, w: F.sum(c).over(w),
    "count": lambda c, w: F.count(c).over(w),
    "p05": lambda c, w: F.percentile(c, F.lit(0.05)).over(w),
    "skew": skewness_sample,
    "kurt": kurtosis_sample,
}


class PanelView:
    def __init__(self, as_of: Column | None = None):
        self.as_of = F.current_date() if as_of is None else as_of
        self.fields: dict[str, None] = {}
        self.lags: dict[str, tuple[str, int]] = {}
        self.definitions: dict[str, Column] = {}
        self.rolls: dict[str, tuple[str, str, int | None]] = {}

    def __getitem__(self, name: str) -> Column:
        self.fields[name] = None
        return F.col(name)

    def cols(self, *names: str) -> list[Column]:
        return [self[n] for n in names]

    def lag(self, name: str, k: int = 1) -> Column:
        """Value ``k`` rows earlier for the same symbol."""
        self.fields[name] = None
        slot = f"__lag{k}_{name}"
        self.lags[slot] = (name, k)
        return F.col(slot)

    def define(self, slot: str, value: Column) -> str:
        """Name a row-wise value (fields and lags only) so that ``roll`` can run over it."""
        self.definitions[f"__{slot}"] = value
        return f"__{slot}"

    def roll(self, how: str, name: str, rows: int | None) -> Column:
        """Aggregate over the current and ``rows - 1`` earlier rows; ``None`` runs from the start."""
        if name not in self.definitions:
            self.fields[name] = None
        slot = f"__{how}{rows or 'all'}_{name}"
        self.rolls[slot] = (how, name, rows)
        return F.col(slot)

    @property
    def windowed(self) -> bool:
        return bool(self.lags or self.rolls)

    def look_back(self) -> int | None:
        """Earlier rows needed for a complete value; ``None`` means all of them."""
        k = max([k for _, k in self.lags.values()], default=0)
        lengths = [n for _, _, n in self.rolls.values()]
        if None in lengths:
            return None
        return k + max(lengths, default=0)


def _years_ago(partition: Sequence[str], order: str, grain: Grain) -> Callable[[str, int], Column]:
    """Value in the same period k years earlier: a RANGE frame of exactly that period."""
    per_year = {Grain.MONTHLY: 12, Grain.QUARTERLY: 4, Grain.ANNUAL: 1}[grain]
    date = F.col(order)
    within = {12: F.month(date), 4: F.quarter(date), 1: F.lit(1)}[per_year]
    by_period = Window.partitionBy(*partition).orderBy(F.year(date) * per_year + within)

    def lagged(name: str, k: int) -> Column:
        frame = by_period.rangeBetween(-per_year * k, -per_year * k)
        return F.max_by(F.col(name), date).over(frame)

    return lagged


class FeatureSet:
    """Features built once against one view: what they read, and how to evaluate them."""

    def __init__(self, features: Sequence[tuple[str, Builder]], as_of: Column | None = None):
        self.view = PanelView(as_of)
        self.columns = {name: build(self.view) for name, build in features}

    @property
    def fields(self) -> list[str]:
        return list(self.view.fields)

    def evaluate(
        self,
        df: DataFrame,
        partition: Sequence[str] = ("symbol",),
        order: str = "date",
        names: dict[str, str] | None = None,
        calendar: Grain | None = None,
    ) -> DataFrame:
        """Add the features to an aligned panel; ``names`` renames some of them.

        With ``calendar`` (monthly grain or coarser) a lag of k is the row k years
        earlier rather than k rows earlier.

        The panel is unique per (symbol, date), so a window partition is bounded by
        the calendar: at most 366 rows a year whatever the data volume.
        """
        view, keep = self.view, df.columns
        by_key = Window.partitionBy(*partition).orderBy(order)
        if view.lags:
            lagged = _years_ago(partition, order, calendar) if calendar else (
                lambda c, k: F.lag(c, k).over(by_key)
            )
            df = df.select("*", *[lagged(c, k).alias(s) for s, (c, k) in view.lags.items()])
        if view.definitions:
            df = df.select("*", *[c.alias(s) for s, c in view.definitions.items()])
        # Costly statistics over frames of fixed length leave the JVM, whatever the length;
        # see operators.rolling.  There and in running frames a NaN counts as missing.
        costly = {
            s: Roll(how, (c,), n)
            for s, (how, c, n) in view.rolls.items()
            if partition and how in STATISTICS and n is not None
        }
        frames = {s: spec for s, spec in view.rolls.items() if s not in costly}
        if frames:
            def frame(rows):
                first = Window.unboundedPreceding if rows is None else -(rows - 1)
                return by_key.rowsBetween(first, Window.currentRow)

            df = df.select(
                "*",
                *[_OVER[how](_known(c) if how in STATISTICS else F.col(c), frame(n)).alias(s)
                  for s, (how, c, n) in frames.items()],
            )
        df = with_rolls(df, costly, partition, order)
        names = names or {}
        results = [c.alias(names.get(n, n)) for n, c in self.columns.items()]
        return df.select(*keep, *results)


def _known(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def dependencies(build: Builder) -> list[str]:
    """Base fields a feature reads (Q08), found by asking it."""
    view = PanelView()
    build(view)
    return list(view.fields)
