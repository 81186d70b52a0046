import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from panelgrain import default_catalog
from panelgrain.sources import landing as L

CATALOG = default_catalog()


def test_conform_renames_drops_and_fills(spark):
    raw = spark.createDataFrame(
        [("AAPL", "2024-01-02", 5.0, "x"), ("", "2024-01-02", 1.0, "y"), ("MSFT", "", 2.0, "z")],
        "symbol string, date string, adjClose double, surprise string",
    )
    rows = {r["symbol"]: r for r in L.conform(raw, CATALOG["daily_price"]).collect()}
    assert set(rows) == {"AAPL", "MSFT"}
    assert rows["AAPL"]["date"] == dt.date(2024, 1, 2) and rows["AAPL"]["adj_close"] == 5.0
    assert rows["MSFT"]["date"] is None and rows["MSFT"]["close"] is None


def test_fractions_of_whole_number_columns_are_rounded(spark):
    raw = spark.createDataFrame([("A", 2.6), ("B", 2.4)], "symbol string, volume double")
    assert [r["volume"] for r in L.conform(raw, CATALOG["daily_price"]).collect()] == [3, 2]


def test_both_spellings_of_an_attribute(spark):
    raw = spark.createDataFrame(
        [("A1", "2024-01-02", "A", None), ("A2", "2024-01-02", None, "D")],
        "symbol string, transactionDate string, acquistionOrDisposition string, "
        "acquisitionOrDisposition string",
    )
    out = L.conform(raw, CATALOG["insider_trades"]).orderBy("symbol").collect()
    assert [r["acquisition_or_disposition"] for r in out] == ["A", "D"]


def test_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "symbol,price,marketCap,name\nAAPL,1.5,10.0,Apple\nMSFT,NaN,None,\nX,Infinity,7,inf\n")
    rows = {r["symbol"]: r for r in L.read_csv(spark, str(tmp_path), CATALOG["quote"]).collect()}
    assert (rows["AAPL"]["price"], rows["AAPL"]["marketCap"]) == (1.5, 10)
    assert rows["MSFT"]["price"] is None and rows["MSFT"]["marketCap"] is None
    assert rows["MSFT"]["name"] is None
    assert rows["X"]["price"] is None and rows["X"]["name"] is None


def test_json_list_object_and_error(spark, tmp_path):
    good = tmp_path / "good"
    good.mkdir()
    (good / "one.json").write_text(json.dumps({"symbol": "A", "price": 1.0}))
    (good / "many.json").write_text(json.dumps([{"symbol": "B", "price": 2.0}, {"symbol": "C"}]))
    got = L.read_json(spark, str(good), CATALOG["quote"]).select("symbol", "price").collect()
    assert sorted((r["symbol"], r["price"]) for r in got) == [("A", 1.0), ("B", 2.0), ("C", None)]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "e.json").write_text(json.dumps({"Error Message": "limit reached"}))
    with pytest.raises(Exception, match="limit reached"):
        L.read_json(spark, str(bad), CATALOG["quote"]).collect()


def test_default_symbol(spark):
    df = spark.createDataFrame([(None, "A"), ("B", "A")], "symbol string, _requested_symbol string")
    assert [r["symbol"] for r in L.stamp_symbol(df).collect()] == ["A", "B"]
    bare = df.drop("symbol")
    assert {r["symbol"] for r in L.stamp_symbol(bare).collect()} == {"A"}


def test_response_key_ignores_parameter_order(spark):
    a = F.create_map(F.lit("x"), F.lit("1"), F.lit("a"), F.lit("2"))
    b = F.create_map(F.lit("a"), F.lit("2"), F.lit("x"), F.lit("1"))
    row = spark.range(1).select(
        L.response_key(F.lit("e"), a).alias("a"), L.response_key(F.lit("e"), b).alias("b")).first()
    assert row["a"] == row["b"]


def test_unexpired(spark):
    df = spark.createDataFrame(
        [("k", "old", "2024-01-01 00:00:00", 60), ("k", "new", "2024-01-01 01:00:00", 7200),
         ("j", "gone", "2024-01-01 00:00:00", 60)],
        "cache_key string, response string, fetched_at string, ttl_seconds int",
    ).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    assert [r["response"] for r in L.unexpired(df, "2024-01-01 02:00:00").collect()] == ["new"]
