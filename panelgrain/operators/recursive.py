"""Per-symbol recursions: exponential smoothing and the indicators built on it.

Smoothing is the one part of the library that Spark's windows cannot express, so
it runs as a grouped map over Arrow tables.  A group is one symbol of a panel that
is unique per (symbol, date): its size is bounded by the calendar (a century of
days is about 36,500 rows), never by the data volume.  All indicators asked for
are computed in one pass over the group.  ``long_ema`` takes series that are not so
bounded, ticks for instance.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import settled

Series = np.ndarray
Indicator = Callable[[Mapping[str, Series]], Series]


# -- small vector helpers (one symbol, in date order) -------------------------
def ema(values: Series, span: int) -> Series:
    """Exponential mean with adjusted weights, seeded from the first row.

    NULL stays NULL in the result; its place in time still decays the weights.
    """
    s = pd.Series(values)
    out = s.ewm(span=span, adjust=True, ignore_na=False, min_periods=1).mean()
    return out.where(s.notna()).to_numpy()


def wilder(values: Series, n: int) -> Series:
    """Wilder's smoothing: the mean of the first ``n`` values, then steps of 1/n."""
    out = np.full(len(values), np.nan)
    first = int(np.argmax(~np.isnan(values))) if (~np.isnan(values)).any() else len(values)
    start = first + n - 1
    if start >= len(values):
        return out
    tail = np.concatenate([[values[first:start + 1].mean()], values[start + 1:]])
    out[start:] = pd.Series(tail).ewm(alpha=1.0 / n, adjust=False).mean().to_numpy()
    return out


def macd(close: Series) -> Series:
    return ema(close, 12) - ema(close, 26)


def dema(close: Series, n: int) -> Series:
    once = ema(close, n)
    return 2 * once - ema(once, n)


def tema(close: Series, n: int) -> Series:
    once = ema(close, n)
    twice = ema(once, n)
    return 3 * once - 3 * twice + ema(twice, n)


def _share(part: Series, whole: Series) -> Series:
    """100 × part / whole, NULL where the whole is zero."""
    safe = np.where(whole == 0, np.nan, whole)
    return 100.0 * part / safe


def rsi(close: Series, n: int) -> Series:
    change = np.diff(close, prepend=np.nan)
    gain = wilder(np.where(np.isnan(change), np.nan, np.maximum(change, 0.0)), n)
    loss = wilder(np.where(np.isnan(change), np.nan, np.maximum(-change, 0.0)), n)
    return _share(gain, gain + loss)


def adx(high: Series, low: Series, close: Series, n: int) -> Series:
    before = np.concatenate([[np.nan], close[:-1]])
    spread = np.maximum(high - low, np.maximum(np.abs(high - before), np.abs(low - before)))
    up, down = np.diff(high, prepend=np.nan), -np.diff(low, prepend=np.nan)
    missing = np.isnan(up)
    plus = np.where(missing, np.nan, np.where((up > down) & (up > 0), up, 0.0))
    minus = np.where(missing, np.nan, np.where((down > up) & (down > 0), down, 0.0))
    base = wilder(spread, n)
    plus_di, minus_di = _share(wilder(plus, n), base), _share(wilder(minus, n), base)
    # No movement either way counts as no direction.
    total = plus_di + minus_di
    direction = np.where(total == 0, 0.0, _share(np.abs(plus_di - minus_di), total))
    return wilder(direction, n)


# -- indicators by name -------------------------------------------------------
def indicator_ema(n: int, column: str = "close") -> Indicator:
    return lambda c: ema(c[column], n)


def indicator_dema(n: int) -> Indicator:
    return lambda c: dema(c["close"], n)


def indicator_tema(n: int) -> Indicator:
    return lambda c: tema(c["close"], n)


def indicator_rsi(n: int) -> Indicator:
    return lambda c: rsi(c["close"], n)


def indicator_adx(n: int) -> Indicator:
    return lambda c: adx(c["high"], c["low"], c["close"], n)


MACD: dict[str, Indicator] = {
    "macd_line": lambda c: macd(c["close"]),
    "macd_signal": lambda c: ema(macd(c["close"]), 9),
    "macd_histogram": lambda c: macd(c["close"]) - ema(macd(c["close"]), 9),
}


def with_indicators(
    df: DataFrame,
    indicators: Mapping[str, Indicator],
    reads: Sequence[str],
    keys: Sequence[str] = ("symbol",),
    order: str = "date",
) -> DataFrame:
    """Add one DOUBLE column per indicator in a single grouped map.

    ``reads`` are the columns the indicators use.  The other columns pass through
    as Arrow data and are never converted to Python objects.
    """
    names = list(indicators)
    base = df.drop(*names)
    schema = T.StructType(
        base.schema.fields + [T.StructField(n, T.DoubleType()) for n in names]
    )
    functions = dict(indicators)

    def per_key(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        columns = {
            c: rows.column(c).to_pandas().to_numpy(dtype="float64", na_value=np.nan) for c in reads
        }
        for name, compute in functions.items():
            rows = rows.append_column(name, pa.array(compute(columns), pa.float64(), from_pandas=True))
        return rows

    return base.groupBy(*keys).applyInArrow(per_key, schema)


# -- one long series over many tasks --------------------------------------------
def _decayed(values: Series, decay: float, start: float) -> Series:
    """s_i = decay * s_(i-1) + values_i, from ``start``."""
    first = values.copy()
    first[0] += decay * start
    # The same recurrence as an unadjusted mean of values / alpha, whose first value counts in full.
    first[1:] /= 1.0 - decay
    return pd.Series(first).ewm(alpha=1.0 - decay, adjust=False).mean().to_numpy()


def _sums_within(columns: list[str], keys: Sequence[str], value: str, decay: float):
    """Adds, within each run of equal keys of a sorted partition, the row's number from one and the
    decayed sums of values and of weights; a run may span several batches."""
    def run(batches):
        last, n, top, weight = None, 0, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(value).to_pandas().to_numpy(dtype="float64", na_value=np.nan)
            known = ~np.isnan(x)
            frame = pa.Table.from_batches([batch.select(list(keys))]).to_pandas()
            before = frame.shift()
            new = (frame.ne(before) & ~(frame.isna() & before.isna())).any(axis=1)
            begin = np.union1d([0], np.flatnonzero(new.to_numpy()))
            out = np.empty((3, len(x)))
            for a, b in zip(begin, np.append(begin[1:], len(x))):
                key = tuple(None if pd.isna(v) else v for v in frame.iloc[a])
                if key != last:
                    last, n, top, weight = key, 0, 0.0, 0.0
                out[0, a:b] = np.arange(n + 1, n + 1 + b - a)
                out[1, a:b] = _decayed(np.where(known[a:b], x[a:b], 0.0), decay, top)
                out[2, a:b] = _decayed(known[a:b].astype(float), decay, weight)
                n, top, weight = n + b - a, out[1, b - 1], out[2, b - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(out[0].astype(np.int64)), pa.array(out[1]), pa.array(out[2])],
                names=[*columns, "__n", "__top", "__weight"])
    return run


def _starts(decay: float, keys: Sequence[str]):
    """The sums with which each chunk of a series begins: the product of the maps of the chunks before it."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("__chunk")
        n, top, weight = (rows.column(c).to_numpy() for c in ("__rows", "__last_top", "__last_weight"))
        begin = np.zeros((2, len(n)))
        for i in range(1, len(n)):
            begin[:, i] = begin[:, i - 1] * decay ** n[i - 1] + (top[i - 1], weight[i - 1])
        return rows.select([*keys, "__chunk"]).append_column("__top0", pa.array(begin[0])).append_column("__weight0", pa.array(begin[1]))
    return run


def long_ema(df: DataFrame, span: int, value: str, order: Sequence[str], name: str = "ema", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """``ema`` of series of any length (W12): one series is spread over as many tasks as its rows need.

    Rows are dealt by sorted ranges of (keys, order).  A stretch of m rows acts on the pair of decayed
    sums as a linear map, x -> decay**m * x + own sums, so each task scans its ranges from zero, the
    maps of the ranges before a chunk are multiplied out (a row per series and range), and the
    start thus found is added to the chunk's rows.  ``order`` must tell the rows of a series apart
    for the result to be defined; rows that are equal in it follow each other in any order.
    """
    decay = 1.0 - 2.0 / (span + 1.0)
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    dealt = settled(dealt.withColumn("__chunk", F.spark_partition_id()))
    schema = T.StructType(dealt.schema.fields + [
        T.StructField("__n", T.LongType()), T.StructField("__top", T.DoubleType()), T.StructField("__weight", T.DoubleType())])
    sums = dealt.mapInArrow(_sums_within(dealt.columns, keys, value, decay), schema)
    chunks = sums.groupBy(*keys, "__chunk").agg(
        F.max("__n").alias("__rows"), F.max_by("__top", "__n").alias("__last_top"), F.max_by("__weight", "__n").alias("__last_weight"))
    start_schema = T.StructType([f for f in chunks.schema.fields if f.name in (*keys, "__chunk")] + [
        T.StructField("__top0", T.DoubleType()), T.StructField("__weight0", T.DoubleType())])
    starts = chunks.groupBy(*keys).applyInArrow(_starts(decay, keys), start_schema)
    starts = starts.select(F.struct(*keys, "__chunk").alias("__key"), "__top0", "__weight0")
    aged = F.pow(F.lit(decay), F.col("__n"))
    mean = (F.col("__top") + aged * F.col("__top0")) / (F.col("__weight") + aged * F.col("__weight0"))
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    joined = sums.join(starts, F.struct(*keys, "__chunk").eqNullSafe(F.col("__key")))
    return joined.select(*df.columns, F.when(known, mean).alias(name))
