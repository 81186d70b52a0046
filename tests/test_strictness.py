"""Inputs that must not be lost, mixed up or looked ahead at."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelgrain.operators import signals
from panelgrain.sources import landing
from panelgrain.sources.catalog import default_catalog
from panelgrain.sources.store import only_symbols


def test_csv_files_with_other_headers_raise(spark, tmp_path):
    spec = default_catalog()["daily_price"]
    (tmp_path / "a.csv").write_text("symbol,date,open,close\nA,2024-01-01,1,2\n")
    (tmp_path / "b.csv").write_text("symbol,date,close,open\nB,2024-01-01,200,100\n")
    same = landing.read_csv(spark, str(tmp_path / "a.csv"), spec).first()
    assert (same["open"], same["close"]) == (1.0, 2.0)
    with pytest.raises(Exception, match="header"):
        landing.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], spec).collect()


def test_broken_json_raises(spark, tmp_path):
    spec = default_catalog()["daily_price"]
    (tmp_path / "a.json").write_text('[{"symbol": "A", "date": "2024-01-01", "close": 2.0}]')
    assert landing.read_json(spark, str(tmp_path), spec).first()["close"] == 2.0
    (tmp_path / "b.json").write_text('[{"symbol": "B", "date"')
    with pytest.raises(Exception, match="no JSON"):
        landing.read_json(spark, str(tmp_path), spec).collect()


@pytest.mark.parametrize("body", ["", " ", '[{"symbol": "B", '])
def test_broken_payload_raises(spark, body):
    spec = default_catalog()["daily_price"]
    raw = spark.createDataFrame([(1, '{"symbol": "A", "close": 2.0}'), (2, body)], "id long, body string")
    with pytest.raises(Exception, match="no JSON"):
        landing.parse_payload(raw, "body", spec).collect()
    assert landing.parse_payload(raw.where("id = 1"), "body", spec).first()["close"] == 2.0


def test_responses_of_one_instant_are_chosen_by_their_content(spark):
    rows = [("k", dt.datetime(2024, 1, 1), 60, body) for body in ("a", "c", "b")]
    made = [spark.createDataFrame(r, "cache_key string, fetched_at timestamp, ttl_seconds int, body string").repartition(3)
            for r in (rows, rows[::-1])]
    got = [landing.unexpired(m, "2024-01-01 00:00:30").first()["body"] for m in made]
    assert got == ["c", "c"]


def test_signals_do_not_look_ahead(spark):
    panel = spark.createDataFrame([("A", dt.date(2024, 1, 10))], "symbol string, date date")
    events = spark.createDataFrame(
        [("A", dt.date(2024, 1, d), "upgrade") for d in (1, 9, 10, 11)], "symbol string, date date, action string")
    got = signals.with_signals(panel, events, signals.pick(signals.grade_signals(), ["upgrades_90d"]),
                               F.lit("2024-01-10").cast("date")).first()
    assert got["upgrades_90d"] == 3


def test_long_and_short_symbol_lists_select_alike(spark):
    df = spark.createDataFrame([(f"S{k}", k) for k in range(500)], "symbol string, v int")
    assert only_symbols(df, ["S1", "S1", "S3"]).count() == 2
    assert only_symbols(df, [f"S{k}" for k in range(300)]).count() == 300
    assert only_symbols(df, []).count() == 0


@pytest.mark.parametrize("rows", [30, 99, 100, 252])
def test_nan_counts_as_missing_in_frames_of_any_length(spark, rows):
    from panelgrain.functions.registry import FeatureRegistry
    from panelgrain.functions.context import FeatureSet

    registry = FeatureRegistry()

    @registry.feature("dev", "mine")
    def dev(p):
        return p.roll("stddev", "close", rows)

    values = [float(k * k % 17) for k in range(300)]
    values[290], values[280] = float("nan"), None
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1) + dt.timedelta(k), v) for k, v in enumerate(values)],
                               "symbol string, date date, close double")
    got = FeatureSet([("dev", registry.features["dev"].build)]).evaluate(df).orderBy(F.col("date").desc()).first()["dev"]
    want = pd.Series([v for v in values[-rows:] if v is not None and v == v]).std()
    assert got == pytest.approx(want, rel=1e-9)
