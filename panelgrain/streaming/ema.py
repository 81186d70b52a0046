"""Running exponential mean per symbol over a stream.

The mean with adjusted weights is the quotient of two decayed sums; they are the
whole state of a symbol, whatever the length of its history.  ``stream_ema`` takes rows
as they arrive; ``stream_ema_in_time`` keeps them until the watermark has passed them and
takes them in event time, so that the result does not depend on how the stream was cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = T.StructType([T.StructField("top", T.DoubleType()), T.StructField("weight", T.DoubleType())])


class RunningEma(StatefulProcessor):
    def __init__(self, span: int, value: str, order: tuple[str, ...]):
        self.decay = 1.0 - 2.0 / (span + 1.0)
        self.value, self.order = value, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ema", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(self.order)
        yield batch.assign(ema=pd.Series(self.means(batch[self.value].astype("float64")), index=batch.index, dtype="float64"))

    def means(self, values: Iterable[float]) -> list[float | None]:
        """The means of ``values`` in their order; the state moves on behind them."""
        top, weight = self.state.get() or (0.0, 0.0)
        out = []
        for x in values:
            top, weight = self.decay * top, self.decay * weight
            known = x == x  # a missing value only lets the earlier ones decay
            if known:
                top, weight = top + x, weight + 1.0
            out.append(top / weight if known else None)
        self.state.update((top, weight))
        return out

    def close(self) -> None:
        pass


def stream_ema(
    stream: DataFrame, span: int, value: str = "value", order: tuple[str, ...] = ("ts", "event_id")
) -> DataFrame:
    """Adds ``ema``; within a micro-batch rows of a symbol are taken in ``order``."""
    schema = T.StructType(stream.schema.fields + [T.StructField("ema", T.DoubleType())])
    return stream.groupBy("symbol").transformWithStateInPandas(
        RunningEma(span, value, order), schema, outputMode="Append", timeMode="None"
    )


#: Rows of a symbol that are kept as one entry of its state.
PIECE = 4096


class EventTimeEma(RunningEma):
    """Rows wait in state until a timer at their time goes off, and are then taken in order.

    State is read and written entry by entry, at a cost far above that of a row; so an entry holds up
    to ``PIECE`` rows, as a list for each column.
    """

    def __init__(self, span: int, value: str, order: tuple[str, ...], schema: T.StructType):
        super().__init__(span, value, order)
        self.names = schema.fieldNames()
        # A timestamp is kept as its microseconds.
        self.times = {f.name for f in schema if isinstance(f.dataType, T.TimestampType)}
        self.whole = {f.name for f in schema if isinstance(f.dataType, T.IntegralType)}
        self.waiting_schema = T.StructType(
            [T.StructField(f.name, T.ArrayType(T.LongType() if f.name in self.times else f.dataType)) for f in schema])

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)

    def wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def listed(self, frame: pd.DataFrame, name: str) -> list:
        values = frame[name].to_numpy()
        if name in self.times:
            return values.astype("datetime64[us]").astype("int64").tolist()
        missing = pd.isna(values)
        if missing.any():
            return [None if gone else int(x) if name in self.whole else x for x, gone in zip(values.tolist(), missing.tolist())]
        return values.astype("int64").tolist() if name in self.whole else values.tolist()

    @staticmethod
    def pieces(columns: list[list]) -> list[tuple]:
        return [tuple(c[k:k + PIECE] for c in columns) for k in range(0, len(columns[0]), PIECE)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            columns = [self.listed(frame, name) for name in self.names]
            self.waiting.appendList(self.pieces(columns))
            least = min(columns[self.names.index(self.order[0])])
            first = least if first is None else min(first, least)
        self.wake(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        columns = [[] for _ in self.names]
        for piece in self.waiting.get():
            for column, part in zip(columns, piece):
                column += part
        by_name = dict(zip(self.names, columns))
        times = by_name[self.order[0]]
        if not times:
            return
        due, later = [k for k, t in enumerate(times) if t <= passed], [k for k, t in enumerate(times) if t > passed]
        if not later:
            self.waiting.clear()
        elif due:
            self.waiting.put(self.pieces([[c[k] for k in later] for c in columns]))
        if later:
            self.wake(min(times[k] for k in later))
        if due:
            ranked = [by_name[name] for name in self.order]
            due.sort(key=lambda k: [(c[k] is None, 0 if c[k] is None else c[k]) for c in ranked])
            out = {name: [c[k] for k in due] for name, c in by_name.items()}
            for name in self.times:
                out[name] = np.array(out[name], "int64").view("datetime64[us]")
            out["ema"] = np.array(self.means(float("nan") if x is None else float(x) for x in out[self.value]), "float64")
            yield pd.DataFrame(out)


def stream_ema_in_time(
    stream: DataFrame, span: int, delay: str, value: str = "value", order: tuple[str, ...] = ("ts", "event_id")
) -> DataFrame:
    """Adds ``ema`` in the order of event time; ``order[0]`` is the event time, later ones break ties.

    A row comes out once the watermark, ``delay`` behind the newest row, has passed it; rows that
    arrive behind the watermark are dropped.  Only rows within the delay are kept.
    """
    schema = T.StructType(stream.schema.fields + [T.StructField("ema", T.DoubleType())])
    return stream.withWatermark(order[0], delay).groupBy("symbol").transformWithStateInPandas(
        EventTimeEma(span, value, order, stream.schema), schema, outputMode="Append", timeMode="EventTime"
    )
