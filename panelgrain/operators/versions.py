"""Version-aware table operators: every load appends, reads pick a version.

Rows carry ``_fetched_at`` (load time), ``_batch_id`` and ``_seq``; the last two
break ties between versions loaded in the same instant.  A key may hold any
number of versions: top-n selection is written as ``row_number() <= n`` so that
Spark's window-group limit discards surplus versions *before* the shuffle and a
heavily revised key never arrives whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FETCHED_AT, BATCH, SEQ = "_fetched_at", "_batch_id", "_seq"


def _newest_first(df: DataFrame, fetched_at: str, seq: str | Sequence[str]) -> list[Column]:
    ties = [seq] if isinstance(seq, str) else list(seq)
    return [F.col(c).desc() for c in [fetched_at, *ties] if c in df.columns]


def keep_newest(
    df: DataFrame,
    keys: Sequence[str],
    n: int = 1,
    fetched_at: str = FETCHED_AT,
    seq: str | Sequence[str] = (BATCH, SEQ),
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """The newest ``n`` versions of each key.

    ``prefer`` orders rows before their age does: with it, ``keys`` may be fewer than
    the table's own, and one shuffle both collapses them and picks the version.
    """
    w = Window.partitionBy(*keys).orderBy(*prefer, *_newest_first(df, fetched_at, seq))
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


def latest(df: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """The newest version of each key."""
    return keep_newest(df, keys, 1, **kw)


def newest_load(
    df: DataFrame, keys: Sequence[str], when: datetime | str | None = None,
    fetched_at: str = FETCHED_AT, batch: str = BATCH,
) -> DataFrame:
    """All rows that the newest load (up to ``when``) brought for each key.

    For events, of which a key may hold several: a load that brings a key brings all its
    events, so a corrected event replaces the old one and equal events stay apart.  The newest
    load of a key is a partial aggregate; the rows meet it in a join, where AQE splits a busy key.
    """
    if when is not None:
        df = df.filter(F.col(fetched_at) <= F.lit(when).cast("timestamp"))
    stamps = [c for c in (fetched_at, batch) if c in df.columns]
    newest = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(F.struct(*stamps)).alias("__newest"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(newest, [*same, F.struct(*stamps).eqNullSafe(F.col("__newest"))], "left_semi")


def descending(text: Column) -> Column:
    """Text whose order is the reverse of ``text``'s; nulls come last."""
    digits = "0123456789ABCDEF"
    return F.coalesce(F.concat(F.translate(F.hex(text), digits, digits[::-1]), F.lit("G")), F.lit("Z"))


def newest_before(
    df: DataFrame, day: date | str, keys: Sequence[str] = ("symbol",), prefer: Sequence[Column] = (),
    date_col: str = "date", fetched_at: str = FETCHED_AT, seq: Sequence[str] = (BATCH, SEQ),
) -> DataFrame:
    """One row per key: the newest version of its last row before ``day``.

    ``prefer``: columns whose greatest value wins among rows of that day, before their age does.
    A partial ``max_by``, so that a key's history is reduced before the shuffle.
    """
    stamps = [c for c in (fetched_at, *seq) if c in df.columns]
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(date_col), *[p.alias(f"p{i}") for i, p in enumerate(prefer)], *stamps)
    early = df.filter(F.col(date_col) < F.lit(day).cast("date"))
    return (early.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def as_of_version(
    df: DataFrame, keys: Sequence[str], when: datetime | str, fetched_at: str = FETCHED_AT, **kw
) -> DataFrame:
    """What a reader at time ``when`` would have seen."""
    when = F.lit(when).cast("timestamp")
    return latest(df.filter(F.col(fetched_at) <= when), keys, fetched_at=fetched_at, **kw)


def revisions(
    df: DataFrame,
    symbol: str | int | None = None,
    fetched_at: str = FETCHED_AT,
    seq: str | Sequence[str] = (BATCH, SEQ),
    **equals,
) -> DataFrame:
    """Every stored version of the matching rows, oldest load first."""
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    for name, value in equals.items():
        df = df.filter(F.col(name) == value)
    ties = [seq] if isinstance(seq, str) else list(seq)
    return df.orderBy(fetched_at, *[c for c in ties if c in df.columns])


def revision_counts(df: DataFrame, keys: Sequence[str], fetched_at: str = FETCHED_AT) -> DataFrame:
    """Number of versions and first/last load time per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"),
        F.min(fetched_at).alias("first_fetched_at"),
        F.max(fetched_at).alias("last_fetched_at"),
    )


def compaction_report(df: DataFrame, keys: Sequence[str], keep: int = 1) -> DataFrame:
    """How many rows a compaction to ``keep`` versions would retain and delete."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    kept = F.sum(F.least(F.col("n"), F.lit(keep)))
    return per_key.agg(
        F.coalesce(kept, F.lit(0)).cast("bigint").alias("kept_rows"),
        F.coalesce(F.sum("n") - kept, F.lit(0)).cast("bigint").alias("deleted_rows"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """Stored rows, old versions included."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def freshness(
    df: DataFrame,
    ttl_seconds: int,
    now: datetime | str | None = None,
    by_symbol: bool = True,
    fetched_at: str = FETCHED_AT,
) -> DataFrame:
    """Last load per symbol (or of the whole table) and whether it is within the TTL."""
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    grouped = df.groupBy("symbol") if by_symbol else df.groupBy()
    out = grouped.agg(F.max(fetched_at).alias("last_fetched_at"))
    expires = F.col("last_fetched_at") + F.make_dt_interval(secs=F.lit(ttl_seconds))
    return out.withColumn("is_fresh", F.coalesce(expires > now, F.lit(False)))


def coverage(
    df: DataFrame, start: date | str | None = None, end: date | str | None = None,
    date_col: str = "date",
) -> DataFrame:
    """Per symbol: first and last date and row count inside the range.

    A symbol absent from the result has nothing in the range.
    """
    if start is not None:
        df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return df.groupBy("symbol").agg(
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def coverage_gaps(
    df: DataFrame, calendar: DataFrame, symbols: DataFrame | None = None, date_col: str = "date"
) -> DataFrame:
    """(symbol, from_date, to_date, missing_days): the stretches of ``calendar`` without a row.

    ``calendar``: the days that should be there, in a ``date`` column; a symbol of ``symbols``
    without any row lacks them all.  Days outside the calendar are ignored, nulls and repeated days too.
    The result is a list of work: fetching its ranges fills the gaps.  A day knows its neighbours in the
    calendar, so a gap is found between two rows of a symbol without listing the days in between.
    """
    w = Window.orderBy("date")  # one row a day: at most 366 a year
    days = calendar.select(F.col("date").cast("date").alias("date")).where("date IS NOT NULL").distinct()
    first, last, count = (days.agg(c).scalar() for c in (F.min("date"), F.max("date"), F.count(F.lit(1))))
    days = days.select("date", F.row_number().over(w).alias("__n"), F.lag("date").over(w).alias("__before"),
                       F.lead("date").over(w).alias("__after"))
    by = Window.partitionBy("symbol").orderBy("date")
    have = df.select("symbol", F.col(date_col).cast("date").alias("date")).where("symbol IS NOT NULL").distinct().join(days, "date")
    at = have.select("symbol", "date", "__n", "__before", "__after", F.coalesce(F.lag("__n").over(by), F.lit(0)).alias("__prev"),
                     F.lag("__after").over(by).alias("__from"), F.lead("__n").over(by).alias("__next"))
    inner = at.where(F.col("__n") - F.col("__prev") > 1).select(
        "symbol", F.coalesce("__from", first).alias("from_date"), F.col("__before").alias("to_date"),
        (F.col("__n") - F.col("__prev") - 1).cast("bigint").alias("missing_days"))
    tail = at.where(F.col("__next").isNull() & (F.col("__n") < count)).select(
        "symbol", F.col("__after").alias("from_date"), last.alias("to_date"), (count - F.col("__n")).cast("bigint").alias("missing_days"))
    wanted = (df if symbols is None else symbols).select("symbol").where("symbol IS NOT NULL").distinct()
    absent = (wanted.join(have.select("symbol").distinct(), "symbol", "left_anti").where(count > 0)
              .select("symbol", first.alias("from_date"), last.alias("to_date"), count.cast("bigint").alias("missing_days")))
    found = inner.unionByName(tail)
    if symbols is not None:
        found = found.join(wanted, "symbol", "left_semi")
    return found.unionByName(absent)


def years_covered(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Calendar years with at least one row."""
    return df.select(F.year(date_col).alias("year")).distinct()


def symbols_with_data(df: DataFrame) -> DataFrame:
    """Distinct symbols, sorted."""
    return df.select("symbol").distinct().orderBy("symbol")


def period_grid(df: DataFrame, key: str, start: date | str, end: date | str, unit: str) -> DataFrame:
    """Wanted work list: each distinct ``key`` with every period start in the range.

    The grid is an ``explode`` of a per-row sequence, so it stays a narrow
    operation on the distinct keys.
    """
    step = {"year": "1 year", "quarter": "3 months", "month": "1 month"}[unit]
    periods = F.sequence(
        F.trunc(F.lit(start).cast("date"), unit),
        F.trunc(F.lit(end).cast("date"), unit),
        F.expr(f"interval {step}"),
    )
    return df.select(key).distinct().select(key, F.explode(periods).alias("period_start"))


def missing_work(wanted: DataFrame, loaded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted keys that have no row yet."""
    return wanted.join(loaded.select(*on).distinct(), list(on), "left_anti")


# The main exchange codes of each country.
MAIN_EXCHANGES = {
    "US": ["NYSE", "NASDAQ", "AMEX"],
    "GB": ["LSE"],
    "DE": ["XETRA", "FSX"],
    "FR": ["PAR"],
    "JP": ["JPX"],
    "CA": ["TSX"],
    "AU": ["ASX"],
    "HK": ["HKSE"],
    "KR": ["KSC", "KOE"],
    "CH": ["SIX"],
    "SG": ["SGX"],
    "IN": ["BSE", "NSE"],
    "CN": ["SHZ", "SHH"],
    "TW": ["TAI", "TWO"],
    "SE": ["STO"],
    "NL": ["AMS"],
    "IT": ["MIL"],
    "ES": ["BME"],
    "BR": ["SAO"],
}


def select_universe(
    profiles: DataFrame,
    countries: Sequence[str] = ("US",),
    exchanges: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Tradable common stock on a country's main exchanges.

    Unknown trading status counts as trading.  On US exchanges a dash or dot in
    the symbol marks a share class and is left out.
    """
    table = MAIN_EXCHANGES if exchanges is None else exchanges
    wanted = sorted({x for c in countries for x in table.get(c.upper(), [])})
    us = table.get("US", [])
    exchange = F.col("exchange_short")
    share_class = F.col("symbol").rlike("[-.]")
    return profiles.filter(
        exchange.isin(wanted)
        & F.coalesce(F.col("is_actively_trading"), F.lit(True))
        & ~F.coalesce(F.col("is_etf"), F.lit(False))
        & ~F.coalesce(F.col("is_fund"), F.lit(False))
        & (F.col("symbol") != "")
        & ~(exchange.isin(us) & share_class)
    ).select("symbol")


def index_universe(df: DataFrame, constituents: DataFrame) -> DataFrame:
    """Rows whose symbol is a constituent."""
    return df.join(constituents.select("symbol"), "symbol", "left_semi")
