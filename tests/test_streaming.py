import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelgrain import FieldSpec, Grain, TableSpec, VersionedStore, default_catalog
from panelgrain.operators import recursive as R
from panelgrain.operators.bars import bars
from panelgrain.streaming import ema as SE
from panelgrain.streaming import ingest as SI

T0 = dt.datetime(2024, 1, 1)
DDL = "symbol string, ts timestamp, event_id bigint, value double"


@pytest.fixture
def files(spark, tmp_path):
    """Three files, so three micro-batches with maxFilesPerTrigger=1."""
    rows = [("A" if i % 3 else "B", T0 + dt.timedelta(minutes=7 * i), i, float(i * 37 % 11))
            for i in range(60)]
    for n in range(3):
        part = spark.createDataFrame(rows[20 * n:20 * n + 20], DDL).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def stream(spark, folder):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_bars_equal_the_batch(spark, files, tmp_path):
    live = SI.stream_bars(stream(spark, files), "30 minutes", "1 hour")
    finish(SI.to_parquet(live, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = {tuple(r) for r in spark.read.schema(live.schema).parquet(str(tmp_path / "out")).collect()}
    every = {tuple(r) for r in bars(spark.read.parquet(files), "30 minutes").collect()}
    assert got and got < every
    # Only bars the watermark has not passed yet are missing.
    newest = max(r[1] for r in every)
    assert all(r[1] > newest - dt.timedelta(hours=2) for r in every - got)


def test_ema_state_carries_over_batches(spark, files, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = SE.stream_ema(stream(spark, files), 5)
        finish(SI.to_parquet(out, str(tmp_path / "out"), str(tmp_path / "cp")))
    finally:
        spark.conf.set(key, before)
    got = {r["event_id"]: r["ema"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = R.with_indicators(spark.read.parquet(files), {"e": R.indicator_ema(5, "value")}, ["value"],
                              order="ts")
    expected = {r["event_id"]: r["e"] for r in batch.collect()}
    assert got == pytest.approx(expected)


def test_replays_are_dropped(spark, files, tmp_path):
    twice = stream(spark, files).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    out = SI.drop_replays(twice, ["event_id"], "ts", "1 day")
    finish(SI.to_parquet(out, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_late_correction_becomes_the_newest_version(spark, tmp_path):
    spec = TableSpec("ticks", Grain.DAILY, ("symbol", "date"), {"px": FieldSpec("px", "price", "double")})
    store = VersionedStore(spark, str(tmp_path / "store"), default_catalog().add(spec))
    folder = str(tmp_path / "in")
    for n, px in enumerate((1.0, 2.0)):
        spark.createDataFrame([("A", "2024-01-02", px)], "symbol string, date string, price double").coalesce(
            1).write.mode("append").json(folder)
        live = spark.readStream.schema("symbol string, date string, price double").json(folder)
        finish(SI.start_ingest(live, store, "ticks", str(tmp_path / "cp")))
        assert store.row_count("ticks") == n + 1
    assert [r["px"] for r in store.read("ticks").collect()] == [2.0]
    assert [r["px"] for r in store.revisions("ticks", "A").collect()] == [1.0, 2.0]
    assert [r["_batch_id"] for r in store.revisions("ticks").collect()] == [f"{n:012d}" for n in (0, 1)]


def test_a_replayed_batch_is_stored_once(spark, files, tmp_path):
    spec = TableSpec("readings", Grain.DAILY, ("symbol", "date"), {"reading": FieldSpec("reading", "value", "double")})
    store = VersionedStore(spark, str(tmp_path / "store"), default_catalog().add(spec))
    live = stream(spark, files).select("symbol", F.col("ts").cast("string").alias("date"), "value",
                                       F.col("ts").alias("_fetched_at"))
    finish(SI.start_ingest(live, store, "readings", str(tmp_path / "cp")))
    assert store.row_count("readings") == 60
    # As if the stream had failed after the last write and before noting it.
    commits = tmp_path / "cp" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    store.append("readings", spark.createDataFrame([("C", "2024-01-01", 1.0)], "symbol string, date string, value double"))
    finish(SI.start_ingest(live, store, "readings", str(tmp_path / "cp")))
    assert store.row_count("readings") == 61  # the load in between stays
    # Another stream with the same batch numbers is another load.
    finish(SI.start_ingest(live, store, "readings", str(tmp_path / "cp2")))
    assert store.row_count("readings") == 121


def test_a_replay_leaves_other_streams_alone(spark, files, tmp_path):
    spec = TableSpec("readings", Grain.DAILY, ("symbol", "date"), {"reading": FieldSpec("reading", "value", "double")})
    store = VersionedStore(spark, str(tmp_path / "store"), default_catalog().add(spec))
    names = "symbol string, date string, value double"
    live = {}
    for name in "AB":
        spark.createDataFrame([(name, "2024-01-02", 1.0)], names).coalesce(1).write.json(str(tmp_path / name))
        live[name] = spark.readStream.schema(names).json(str(tmp_path / name))
    calls, put = [], VersionedStore._write

    def failing(*args, **kw):
        put(*args, **kw)
        if not calls and args[3] != "rows":
            calls.append(1)
            raise RuntimeError("after the write")

    store._write = failing.__get__(store)
    query = SI.start_ingest(live["A"], store, "readings", str(tmp_path / "cpA"))
    with pytest.raises(Exception, match="after the write"):
        query.awaitTermination()
    del store._write
    finish(SI.start_ingest(live["B"], store, "readings", str(tmp_path / "cpB")))  # its batch 0 too
    finish(SI.start_ingest(live["A"], store, "readings", str(tmp_path / "cpA")))
    assert sorted(r["symbol"] for r in store.frame("readings").collect()) == ["A", "B"]
    # A compaction takes the batches of the years it rewrites.
    store.append("readings", spark.createDataFrame([("A", "2024-01-02", 2.0)], names))
    assert store.compact("readings") == 1 and store.row_count("readings") == 2
    assert [r["reading"] for r in store.read("readings").collect()] == [2.0, 1.0]


@pytest.mark.parametrize("split", [(20, 40), (7, 13, 31, 50), (60,)])
def test_the_mean_in_event_time_does_not_depend_on_the_split(spark, tmp_path, split):
    """Every third row comes a part late; a null value and equal times are among them."""
    rows = [("A" if i % 3 else "B", T0 + dt.timedelta(minutes=7 * (i // 2)), i, None if i == 17 else float(i * 37 % 11)) for i in range(60)]
    end = [("end", T0 + dt.timedelta(days=99), -1, 0.0)]
    part = [sum(i >= b for b in split) + (i % 5 == 0) for i in range(60)]
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for n in range(max(part) + 2):
            now = [r for r, p in zip(rows, part) if p == n] if n <= max(part) else end
            if not now:
                continue
            spark.createDataFrame(now, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            live = spark.readStream.schema(DDL).parquet(str(tmp_path / "in"))
            out = SE.stream_ema_in_time(live, 5, "1 day")
            finish(SI.to_parquet(out, str(tmp_path / "out"), str(tmp_path / "cp")))
    finally:
        spark.conf.set(key, before)
    got = {r["event_id"]: r["ema"] for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()}
    assert set(got) == set(range(60))  # the last row is still waiting
    for symbol in "AB":
        mine = [r for r in rows if r[0] == symbol]
        want = R.ema(np.array([np.nan if r[3] is None else r[3] for r in mine]), 5)
        for r, w in zip(mine, want):
            assert got[r[2]] is None if r[3] is None else got[r[2]] == pytest.approx(w)
    # Of the rows that are done nothing waits in state any longer.
    state = (spark.read.format("statestore").option("stateVarName", "waiting").option("flattenCollectionTypes", True)
             .load(str(tmp_path / "cp")))
    assert [r["key"]["symbol"] for r in state.collect()] == ["end"]


def test_waiting_rows_of_a_symbol_are_few_entries_of_state(spark, tmp_path):
    """All rows of a micro-batch that wait are one entry of their symbol, and lose nothing there."""
    rows = [("A", T0 + dt.timedelta(minutes=(7 * i) % 60), i if i % 5 else None, None if i % 7 == 0 else float(i)) for i in range(60)]
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(str(tmp_path / "in"))
        out = SE.stream_ema_in_time(spark.readStream.schema(DDL).parquet(str(tmp_path / "in")), 5, "1 day")
        finish(SI.to_parquet(out, str(tmp_path / "out"), str(tmp_path / "cp")))
        state = (spark.read.format("statestore").option("stateVarName", "waiting").option("flattenCollectionTypes", True)
                 .load(str(tmp_path / "cp"))).collect()
    finally:
        spark.conf.set(key, before)
    assert len(state) == 1
    kept = state[0]["list_element"]
    assert sorted(kept["event_id"], key=str) == sorted((r[2] for r in rows), key=str)
    assert sorted(kept["value"], key=str) == sorted((r[3] for r in rows), key=str)
