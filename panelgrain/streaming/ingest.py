"""Versioned ingest from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import conform
from ..sources.store import VersionedStore


def start_ingest(
    stream: DataFrame, store: VersionedStore, table: str, checkpoint: str,
    conformed: bool = False, available_now: bool = True,
) -> StreamingQuery:
    """Append every micro-batch as new versions; a late correction is simply a newer row.

    The batch id goes into ``_batch_id`` (zero-padded, so it orders as text).  Each batch is a
    partition of its stream and number; a replay of one that failed, wholly or partly written,
    overwrites that partition and nothing else.
    """
    spec = store.catalog[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = batch if conformed else conform(batch, spec)
        store.put_batch(table, rows, stream_id, f"{batch_id:012d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def drop_replays(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop a version that arrives again within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def stream_bars(stream: DataFrame, interval: str, delay: str, ts: str = "ts", **kw) -> DataFrame:
    """Bars that are emitted once the watermark has passed them."""
    from ..operators.bars import bars

    return bars(stream.withWatermark(ts, delay), interval, ts=ts, **kw)


def to_parquet(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as a TIMESTAMP, as watermarks need it."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
