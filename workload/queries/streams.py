"""The streaming operators, run to completion over the event file.

Each query starts a stream with the ``availableNow`` trigger and returns what its
sink holds afterwards.  Sinks and checkpoints go to the cluster's shared folder
(``spark.checkpoint.dir``); only where none is set, as in tests, to a new
temporary folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain import FieldSpec, Grain, TableSpec, VersionedStore, default_catalog
from panelgrain.plans.session import shared_folder
from panelgrain.streaming import ema as SE
from panelgrain.streaming import ingest as SI

from .. import oracle as O
from .. import views as V

SPAN = 10
EVENT_TABLE = TableSpec(
    "user_events", Grain.DAILY, ("symbol", "date"),
    {f.name: f for f in (FieldSpec("event_value", "value", "double"),
                         FieldSpec("event_kind", "event_type", "string"),
                         FieldSpec("event_number", "event_id", "bigint"))},
)


def _folder(spark):
    return shared_folder(spark, "stream")


def _stream(spark, sf_dir):
    schema = V.table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return SI.event_time(raw.withColumn("symbol", F.col("user_id").cast("string")), "ts")


def _finish(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


PARTS = 3
DELAY = "20 days"


def _part(spark, sf_dir, folder, part):
    """Adds a third of the events to ``folder``, by day; one event in ten arrives a part late."""
    day = F.dayofmonth(F.col("ts").cast("date"))
    late = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    of = F.least(F.floor((day - 1) / 10) + late, F.lit(PARTS - 1))
    V.events(spark, sf_dir).filter(of == part).select(
        "symbol", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value", "event_type").write.mode("append").parquet(folder)


def _end(spark, folder):
    """A last row, long after all others: it moves the watermark past them."""
    spark.range(1).select(
        F.lit("end").alias("symbol"), F.lit("2100-01-01").cast("timestamp").alias("ts"), F.lit(-1).cast("bigint").alias("event_id"),
        F.lit(0.0).alias("value"), F.lit("end").alias("event_type")).write.mode("append").parquet(folder)


PART_SCHEMA = "symbol string, ts timestamp, event_id bigint, value double, event_type string"


def _parts(spark, folder):
    return spark.readStream.schema(PART_SCHEMA).parquet(folder)


def t01_versioned_ingest(spark, sf_dir):
    """Events streamed into a versioned table in three runs of one stream, each from where the last
    one ended, with a compaction between them; the newest version per user and day is read."""
    folder = _folder(spark)
    store = VersionedStore(spark, f"{folder}/store", default_catalog().add(EVENT_TABLE))
    for part in range(PARTS):
        _part(spark, sf_dir, f"{folder}/in", part)
        rows = _parts(spark, f"{folder}/in").select(
            "symbol", F.col("ts").cast("string").alias("date"), "value", "event_type", "event_id",
            F.col("ts").alias("_fetched_at"), F.col("event_id").alias("_seq"),
        )
        _finish(SI.start_ingest(rows, store, "user_events", f"{folder}/checkpoint"))
        if part == 1:
            store.compact("user_events")
    return V.rounded(store.scan("user_events"))


T01 = f"""
SELECT symbol, date, {O.r6("value")} AS event_value, event_type AS event_kind,
       event_id AS event_number
FROM ev QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC, event_id DESC) = 1"""


def t02_drop_replays(spark, sf_dir):
    """Every part of the stream arrives twice, also a run later; every version is kept once."""
    folder = _folder(spark)
    for part in range(PARTS):
        for again in {part, max(part - 1, 0)}:
            _part(spark, sf_dir, f"{folder}/in", again)
        twice = _parts(spark, f"{folder}/in").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
        unique = SI.drop_replays(twice, ["event_id"], "ts", "60 days")
        _finish(SI.to_parquet(unique, f"{folder}/out", f"{folder}/checkpoint"))
    return V.rounded(spark.read.parquet(f"{folder}/out").select("symbol", "event_id", "value"))


T02 = f"SELECT symbol, event_id, {O.r6('value')} AS value FROM ev"


def t03_stream_bars(spark, sf_dir):
    """Hourly bars from the stream, all of which its last row closes."""
    folder = _folder(spark)
    _end(spark, f"{folder}/end")
    columns = ["symbol", "ts", "event_id", "value", "event_type"]
    ticks = _stream(spark, sf_dir).select(*columns).unionByName(_parts(spark, f"{folder}/end"))
    stream = SI.stream_bars(ticks, "1 hour", "1 day")
    _finish(SI.to_parquet(stream, f"{folder}/out", f"{folder}/checkpoint"))
    done = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    return V.rounded(done.withColumn("bar_start", F.date_format("bar_start", "yyyy-MM-dd HH:mm")))


T03 = f"""
SELECT symbol, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS bar_start,
       {O.r6("first(value ORDER BY ts, event_id)")} AS open, {O.r6("max(value)")} AS high,
       {O.r6("min(value)")} AS low, {O.r6("last(value ORDER BY ts, event_id)")} AS close,
       count(*) AS volume
FROM ev GROUP BY symbol, date_trunc('hour', ts)"""


def t04_stream_ema(spark, sf_dir):
    """Three runs of one stream, with events that come a run late, give the mean in event time."""
    folder = _folder(spark)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(
        provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        for part in range(PARTS):
            _part(spark, sf_dir, f"{folder}/in", part)
            if part == PARTS - 1:
                _end(spark, f"{folder}/in")
            rows = _parts(spark, f"{folder}/in").select("symbol", "ts", "event_id", "value")
            stream = SE.stream_ema_in_time(rows, SPAN, DELAY)
            _finish(SI.to_parquet(stream, f"{folder}/out", f"{folder}/checkpoint"))
    finally:
        spark.conf.set(provider, before)
    done = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    return V.rounded(done.select("symbol", "event_id", "value", "ema"))


T04 = f"""
WITH numbered AS (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) AS rn,
           pow({SPAN + 1}.0::DOUBLE / {SPAN - 1}, rn) AS growth FROM ev
)
SELECT symbol, event_id, {O.r6("value")} AS value,
       {O.r6("sum(value * growth) OVER run / sum(growth) OVER run")} AS ema
FROM numbered WINDOW run AS (PARTITION BY symbol ORDER BY rn ROWS UNBOUNDED PRECEDING)"""

QUERIES = {
    "t01_versioned_ingest": (t01_versioned_ingest, O.sql(T01)),
    "t02_drop_replays": (t02_drop_replays, O.sql(T02)),
    "t03_stream_bars": (t03_stream_bars, O.sql(T03)),
    "t04_stream_ema": (t04_stream_ema, O.sql(T04)),
}
