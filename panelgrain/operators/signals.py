"""Event signals: counts and sums of recent events per symbol.

Two readings of "recent":

* :func:`with_signals` counts back from one day for all rows of a symbol;
* :func:`with_trailing_signals` counts back from each row's own date, so a row never
  sees later events.

All signals of one event table come out of ONE partially aggregated ``groupBy``; a
symbol with very many events is combined map-side before the shuffle.  Distinct
traders are counted by Spark's distinct aggregation, which spreads a hot symbol over
its traders first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ratio


@dataclass(frozen=True)
class Term:
    """Events of the last ``days`` days that satisfy ``when``: how many, their ``total``,
    or how many ``distinct`` values."""

    days: int
    when: Column
    total: Column | None = None
    distinct: Column | None = None


@dataclass(frozen=True)
class Signal:
    """``value`` reads the terms by name; ``missing`` is given to symbols without events."""

    terms: Mapping[str, Term]
    value: Column
    missing: Column


def _all_terms(signals: Mapping[str, Signal]) -> dict[str, Term]:
    return {n: t for s in signals.values() for n, t in s.terms.items()}


def _holds(term: Term, extra: Column | None = None) -> Column:
    when = term.when if extra is None else term.when & extra
    return F.coalesce(when, F.lit(False))


def _aggregate(term: Term, when: Column) -> Column:
    if term.total is not None:
        return F.coalesce(F.sum(F.when(when, term.total)), F.lit(0.0))
    if term.distinct is not None:
        return F.count_distinct(F.when(when, term.distinct))
    return F.count_if(when)


def with_signals(
    df: DataFrame, events: DataFrame, signals: Mapping[str, Signal], as_of: Column
) -> DataFrame:
    """Left join of per-symbol aggregates of the events from ``as_of`` minus the days to ``as_of``."""
    terms = _all_terms(signals)
    per_symbol = events.groupBy("symbol").agg(*[
        _aggregate(t, _holds(t, F.col("date").between(F.date_sub(as_of, t.days), as_of))).alias(n)
        for n, t in terms.items()
    ])
    joined = df.join(per_symbol.withColumn("__seen", F.lit(True)), "symbol", "left")
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("__seen"), s.value).otherwise(s.missing).alias(name)
            for name, s in signals.items()
        ],
    )


def _distinct_changes(events: DataFrame, name: str, term: Term) -> DataFrame:
    """Days on which the trailing number of distinct values rises or falls.

    A value counts from its event until ``days`` after it; events of one value that
    are no further apart than that make one stay.  The window holds one value of one
    symbol, one row per day.
    """
    seen = events.filter(_holds(term)).select("symbol", "date", term.distinct.alias("__v")).distinct()
    w = Window.partitionBy("symbol", "__v").orderBy("date")
    gap_before = F.datediff("date", F.lag("date").over(w))
    gap_after = F.datediff(F.lead("date").over(w), "date")
    marked = seen.select(
        "symbol", "date",
        F.coalesce(gap_before > term.days, F.lit(True)).alias("__enters"),
        F.coalesce(gap_after > term.days, F.lit(True)).alias("__leaves"),
    )
    enters = marked.filter("__enters").select("symbol", "date", F.lit(1).alias("__d"))
    leaves = marked.filter("__leaves").select(
        "symbol", F.date_add("date", term.days + 1).alias("date"), F.lit(-1).alias("__d")
    )
    return enters.unionByName(leaves).groupBy("symbol", "date").agg(F.sum("__d").alias(name))


def with_trailing_signals(
    df: DataFrame, events: DataFrame, signals: Mapping[str, Signal]
) -> DataFrame:
    """Signals over the days up to and including each row's date.

    Events are summed per (symbol, day) first; the windows then run over at most one
    row per day and side.
    """
    terms = _all_terms(signals)
    plain = {n: t for n, t in terms.items() if t.distinct is None}
    sides = df.select("symbol", "date", F.struct(*df.columns).alias("__row"))
    if plain:
        per_day = events.groupBy("symbol", "date").agg(
            *[_aggregate(t, _holds(t)).alias(n) for n, t in plain.items()]
        )
        sides = sides.unionByName(per_day, allowMissingColumns=True)
    for n, t in terms.items():
        if t.distinct is not None:
            sides = sides.unionByName(_distinct_changes(events, n, t), allowMissingColumns=True)
    by_day = Window.partitionBy("symbol").orderBy("__day")

    def window(term: Term):
        back = Window.unboundedPreceding if term.distinct is not None else -term.days
        return by_day.rangeBetween(back, Window.currentRow)

    sides = sides.withColumn("__day", F.unix_date("date"))
    counted = sides.select(
        "__row",
        *[F.coalesce(F.sum(n).over(window(t)), F.lit(0)).alias(n) for n, t in terms.items()],
    ).filter(F.col("__row").isNotNull())
    return counted.select(
        *[F.col(f"__row.{c}").alias(c) for c in df.columns],
        *[s.value.alias(name) for name, s in signals.items()],
    )


def insider_signals(long: int = 90, short: int = 30) -> dict[str, Signal]:
    bought = F.col("acquisition_or_disposition") == "A"
    sold = F.col("acquisition_or_disposition") == "D"
    worth = F.col("securities_transacted").cast("double") * F.col("insider_price")
    owner = F.lower("type_of_owner")
    senior = owner.contains("officer") | owner.contains("director")
    # A missing name counts as one more trader.
    trader = F.coalesce("reporting_name", F.lit("\0"))
    terms = {
        "__buy_value": Term(long, bought, total=worth),
        "__sell_value": Term(long, sold, total=worth),
        "__buys_long": Term(long, bought),
        "__sells_long": Term(long, sold),
        "__buys_short": Term(short, bought),
        "__sells_short": Term(short, sold),
        "__senior_buys": Term(long, bought & senior),
        "__traders": Term(short, bought, distinct=trader),
    }

    def signal(value: Column, missing, *names: str) -> Signal:
        return Signal({n: terms[n] for n in names}, value, F.lit(missing))

    c = F.col
    return {
        "insider_net_buying_90d": signal(
            c("__buy_value") - c("__sell_value"), 0.0, "__buy_value", "__sell_value"),
        "insider_buy_count_30d": signal(c("__buys_short"), 0, "__buys_short"),
        "insider_sell_count_30d": signal(c("__sells_short"), 0, "__sells_short"),
        "insider_buy_sell_ratio_90d": signal(
            ratio(c("__buys_long"), c("__sells_long")), None, "__buys_long", "__sells_long"),
        "insider_buying_cluster": signal((c("__traders") >= 3).cast("int"), 0, "__traders"),
        "insider_total_bought_90d": signal(c("__buy_value"), 0.0, "__buy_value"),
        "insider_total_sold_90d": signal(c("__sell_value"), 0.0, "__sell_value"),
        "insider_officer_buying": signal((c("__senior_buys") > 0).cast("int"), 0, "__senior_buys"),
    }


def senate_signals(long: int = 90, short: int = 30) -> dict[str, Signal]:
    kind = F.lower("type")
    terms = {
        "__purchases": Term(long, kind.contains("purchase")),
        "__sales": Term(long, kind.contains("sale")),
        "__latest": Term(short, F.lit(True)),
    }

    def signal(value: Column, *names: str) -> Signal:
        return Signal({n: terms[n] for n in names}, value, F.lit(0))

    return {
        "senate_buy_count_90d": signal(F.col("__purchases"), "__purchases"),
        "senate_sell_count_90d": signal(F.col("__sales"), "__sales"),
        "senate_net_flow_90d": signal(
            F.col("__purchases") - F.col("__sales"), "__purchases", "__sales"),
        "senate_activity_flag": signal((F.col("__latest") > 0).cast("int"), "__latest"),
    }


def grade_signals(long: int = 90) -> dict[str, Signal]:
    action = F.lower("action")
    up, down = Term(long, action == "upgrade"), Term(long, action == "downgrade")
    ups, downs = F.col("__upgrades"), F.col("__downgrades")
    return {
        "upgrades_90d": Signal({"__upgrades": up}, ups, F.lit(0)),
        "downgrades_90d": Signal({"__downgrades": down}, downs, F.lit(0)),
        "upgrade_downgrade_ratio": Signal(
            {"__upgrades": up, "__downgrades": down}, ratio(ups, downs), F.lit(None)),
    }


def reach(signals: Mapping[str, Signal]) -> int:
    """Days that the signals look back."""
    return max(t.days for s in signals.values() for t in s.terms.values())


def pick(signals: Mapping[str, Signal], names: Sequence[str]) -> dict[str, Signal]:
    return {n: signals[n] for n in names}
