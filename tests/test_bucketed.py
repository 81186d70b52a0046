import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from panelgrain import BucketedStore, FrameSource, PanelQuery, VersionedStore
from panelgrain.functions.features import default_registry

REGISTRY = default_registry()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def prices(spark, scale=1.0):
    return spark.range(1200).select(
        F.concat(F.lit("S"), (F.col("id") % 13).cast("string")).alias("symbol"),
        F.date_add(F.lit("2021-11-01").cast("date"), F.floor(F.col("id") / 13).cast("int") * 4).alias("date"),
        (F.lit(scale) * (10 + F.col("id") % 97)).alias("close"), F.col("id").alias("volume"))


def statements(spark):
    return spark.range(60).select(
        F.concat(F.lit("S"), (F.col("id") % 13).cast("string")).alias("symbol"),
        F.date_add(F.lit("2021-09-30").cast("date"), F.floor(F.col("id") / 13).cast("int") * 91).alias("date"),
        F.when(F.col("id") % 4 == 0, "FY").otherwise("Q1").alias("period"),
        (F.col("id") * 1000).alias("revenue"), F.col("id").alias("net_income"))


def quotes(spark):
    return spark.range(13).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), (F.col("id") + 0.5).alias("price"))


@pytest.fixture
def both(spark, tmp_path):
    given = FrameSource({"daily_price": prices(spark), "income_statement": statements(spark), "quote": quotes(spark)})
    store = BucketedStore(spark, str(tmp_path), buckets=4)
    for table in ("daily_price", "income_statement", "quote"):
        store.publish(table, given)
    return given, store


FIELDS = ("close", "revenue", "net_income", "return_5d", "sma_20", "price")


@pytest.mark.parametrize("start", [None, "2022-02-03"])
@pytest.mark.parametrize("grain", ["daily", "weekly"])
def test_panels_without_an_exchange(spark, both, start, grain):
    given, store = both

    def ask(source):
        q = PanelQuery(source, REGISTRY).all_symbols().select(*FIELDS).grain(grain)
        return (q.date_range(start, "2022-12-31") if start else q).execute()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = plan(ask(store))
        rows = sorted(map(tuple, ask(store).collect()), key=str)
        assert "Exchange" not in told and "Bucketed: true" in told
        assert "Exchange" in plan(ask(given))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows and rows == sorted(map(tuple, ask(given).collect()), key=str)


def test_bounds_reach_folders_and_scan(spark, both):
    told = plan(both[1].scan("daily_price", ["close"], ["S3"], "2022-01-05", "2022-02-01"))
    assert "date_year" in told.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(symbol,S3)" in told or "GreaterThanOrEqual(symbol,S3)" in told
    assert "volume" not in told.split("ReadSchema")[1]


def test_one_file_per_year_and_bucket(both):
    _, store = both
    folder = f"{store.root}/daily_price"
    years = sorted(d for d in os.listdir(folder) if d.startswith("date_year="))
    assert years == ["date_year=2021", "date_year=2022"]
    for year in years:
        assert len([f for f in os.listdir(f"{folder}/{year}") if f.endswith(".parquet")]) <= 4


def test_refresh_rewrites_touched_years_alone(spark, tmp_path):
    versioned = VersionedStore(spark, str(tmp_path / "store"))
    versioned.append_conformed("daily_price", conformed(prices(spark), versioned), "2024-01-01 00:00:00")
    store = BucketedStore(spark, str(tmp_path / "published"), buckets=4)
    store.publish("daily_price", versioned)
    folder = f"{store.root}/daily_price"
    before = {y: sorted(os.listdir(f"{folder}/date_year={y}")) for y in (2021, 2022)}
    late = prices(spark, 2.0).where(F.year("date") == 2022).unionByName(
        prices(spark).limit(1).select("symbol", F.lit(None).cast("date").alias("date"), "close", "volume"))
    versioned.append_conformed("daily_price", conformed(late, versioned), "2024-02-01 00:00:00")
    assert store.refresh("daily_price", versioned, "2024-01-01 00:00:00") == [None, 2022]
    assert store.refresh("daily_price", versioned, "2024-02-01 00:00:00") == []
    assert sorted(os.listdir(f"{folder}/date_year=2021")) == before[2021]
    assert sorted(os.listdir(f"{folder}/date_year=2022")) != before[2022]

    def rows(source):
        return sorted((tuple(r) for r in source.scan("daily_price", ["close"]).collect()), key=str)

    assert rows(store) == rows(versioned)
    assert len(rows(store)) == 1201
    # Another store on the folder knows what is there, under a catalogue that lost the table too.
    spark.sql(f"DROP TABLE {store._name('daily_price')}")
    assert rows(BucketedStore(spark, str(tmp_path / "published"), buckets=4)) == rows(versioned)


def conformed(rows, store):
    schema = store.catalog["daily_price"].schema()
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schema])


def test_publication_replaces(spark, both):
    _, store = both
    fewer = prices(spark).where(F.year("date") == 2021)
    store.publish("daily_price", FrameSource({"daily_price": fewer}))
    assert store.scan("daily_price", ["close"]).count() == fewer.count()
    store.publish("daily_price", FrameSource({"daily_price": prices(spark).limit(0)}))
    assert store.scan("daily_price", ["close"]).count() == 0


def test_what_is_refused(spark, tmp_path):
    store = BucketedStore(spark, str(tmp_path), buckets=2)
    with pytest.raises(ValueError, match="not published"):
        store.frame("daily_price")
    with pytest.raises(ValueError, match="not published"):
        store.refresh("daily_price", VersionedStore(spark, str(tmp_path)), dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="no symbol"):
        store.publish("treasury_rates", FrameSource({}))
    with pytest.raises(ValueError, match="bucket"):
        BucketedStore(spark, str(tmp_path), buckets=0)
