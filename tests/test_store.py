import datetime as dt
import pathlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelgrain import PanelQuery


def _prices(spark, rows):
    return spark.createDataFrame(rows)


def test_write_and_read(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows))
    rows = store.read("daily_price", ["AAPL"]).collect()
    assert [r["close"] for r in rows] == [180.0, 185.0]
    assert store.row_count("daily_price") == 2


def test_newest_version_wins_and_revisions_keep_all(spark, store, price_rows):
    first = dict(price_rows[0], close=183.0)
    second = dict(price_rows[0], close=185.0)
    store.append("daily_price", _prices(spark, [first]), "2024-02-01 10:00:00", 1)
    store.append("daily_price", _prices(spark, [second]), "2024-02-01 11:00:00", 2)
    assert store.row_count("daily_price") == 2
    assert [r["close"] for r in store.read("daily_price", ["AAPL"]).collect()] == [185.0]
    assert [r["close"] for r in store.revisions("daily_price", "AAPL", date="2024-01-15").collect()] \
        == [183.0, 185.0]
    old = store.scan("daily_price", version_as_of="2024-02-01 10:30:00").collect()
    assert [r["close"] for r in old] == [183.0]


def test_same_instant_is_decided_by_batch_and_sequence(spark, store, price_rows):
    for batch, close in (("000", 1.0), ("001", 2.0)):
        store.append("daily_price", _prices(spark, [dict(price_rows[0], close=close)]),
                     "2024-02-01 10:00:00", batch)
    assert store.read("daily_price").first()["close"] == 2.0


def test_date_filter_prunes_partitions(spark, store, price_rows):
    rows = price_rows + [dict(price_rows[0], date="2022-05-02")]
    store.append("daily_price", _prices(spark, rows))
    got = store.read("daily_price", None, "2022-01-01", "2022-12-31")
    assert [r["date"] for r in got.collect()] == [dt.date(2022, 5, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "date_year" in plan.split("PartitionFilters")[1].split("]")[0]


def test_column_pruning_reaches_the_scan(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows))
    plan = store.scan("daily_price", ["close"])._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1]
    assert "close" in schema and "vwap" not in schema


def test_empty_table_reads_empty(store):
    assert store.read("quote").count() == 0
    store.create("quote")
    assert store.read("quote").count() == 0 and store.row_count("quote") == 0
    assert "price" in store.read("quote").columns


def test_compact_keeps_the_newest(spark, store, price_rows):
    for n in range(4):
        row = dict(price_rows[0], close=float(n))
        store.append("daily_price", _prices(spark, [row]), f"2024-02-01 1{n}:00:00", n)
    assert store.compact("daily_price", keep=2) == 2
    assert [r["close"] for r in store.revisions("daily_price").collect()] == [2.0, 3.0]
    assert store.compact("daily_price", keep=2) == 0
    store.append("daily_price", _prices(spark, [dict(price_rows[0], close=9.0)]), "2024-02-02", 9)
    assert store.read("daily_price").first()["close"] == 9.0


def test_source_names(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows))
    row = store.read_source_names("daily_price").first()
    assert row["adjClose"] == 180.0 and row["changePercent"] == 1.5


def test_freshness_coverage_years_symbols(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows), "2024-02-01 10:00:00")
    fresh = store.freshness("daily_price", 3600, "2024-02-01 10:59:00").first()
    stale = store.freshness("daily_price", 3600, "2024-02-01 11:01:00").first()
    assert fresh["is_fresh"] and not stale["is_fresh"]
    cover = store.coverage("daily_price", "2024-01-01", "2024-01-15").first()
    assert cover["row_count"] == 1 and cover["last_date"] == dt.date(2024, 1, 15)
    assert store.coverage("daily_price", "2025-01-01").count() == 0
    assert [r["year"] for r in store.years_covered("daily_price").collect()] == [2024]
    assert [r["symbol"] for r in store.symbols_with_data("daily_price").collect()] == ["AAPL"]
    assert store.symbols_with_data("treasury_rates").count() == 0


def test_adhoc_sql(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows))
    got = store.sql("SELECT max(close) AS c FROM daily_price WHERE symbol = :s", {"s": "AAPL"})
    assert got.first()["c"] == 185.0


def test_long_symbol_lists_are_joined(spark, store, price_rows):
    store.append("daily_price", _prices(spark, price_rows))
    many = [f"S{i}" for i in range(500)] + ["AAPL"]
    got = store.scan("daily_price", ["close"], many)
    assert got.count() == 2
    assert "LeftSemi" in got._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_limited_before_the_shuffle(spark):
    from panelgrain.operators.versions import latest

    df = spark.range(10_000).select(
        F.concat(F.lit("HOT"), F.col("id") % 1).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 1).cast("int")).alias("date"),
        F.timestamp_seconds("id").alias("_fetched_at"), F.col("id").alias("_seq"))
    out = latest(df.repartition(4), ["symbol", "date"])
    assert [r["_seq"] for r in out.collect()] == [9_999]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_statement_read_collapses_periods_and_versions_in_one_shuffle(spark, store):
    from panelgrain import PanelQuery

    def put(period, revenue, hour):
        rows = spark.createDataFrame([("A", "2023-12-31", period, revenue)],
                                     "symbol string, date string, period string, revenue bigint")
        store.append("income_statement", rows, f"2024-02-01 {hour}:00:00", hour)

    put("Q4", 100, "10")
    put("Q4", 110, "11")
    put("FY", 400, "12")
    query = PanelQuery(store).symbols("A").select("revenue")
    df = query.execute()
    assert [r["revenue"] for r in df.collect()] == [110]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert PanelQuery(store).symbols("A").select("revenue").period("annual").execute().first()[2] == 400
    early = PanelQuery(store).symbols("A").select("revenue").version_as_of("2024-02-01 10:30:00")
    assert early.execute().first()["revenue"] == 100


def _folder(store, table):
    return pathlib.Path(store.path(table).removeprefix("file:"))


def test_files_are_in_key_order(spark, store, price_rows):
    rows = [dict(price_rows[0], symbol=s, date=f"2024-01-{d:02d}") for d in (9, 3, 5) for s in ("ZZ", "AA", "MM")]
    store.append("daily_price", _prices(spark, rows))
    files = list(_folder(store, "daily_price").rglob("*.parquet"))
    assert files
    for file in files:
        keys = pq.ParquetFile(file).read(["symbol", "date"]).to_pylist()
        assert keys == sorted(keys, key=lambda r: (r["symbol"], r["date"]))


def test_compaction_rewrites_only_years_with_surplus_versions(spark, store, price_rows):
    def files(year):
        return {f.name for f in (_folder(store, "daily_price") / "load=rows" / f"date_year={year}").glob("*.parquet")}

    for n in range(3):
        store.append("daily_price", _prices(spark, [dict(price_rows[0], close=float(n))]), f"2024-02-01 1{n}:00:00", n)
    store.append("daily_price", _prices(spark, [dict(price_rows[0], date="2022-05-02")]))
    before = files(2022), files(2024)
    assert store.compact("daily_price") == 2
    assert files(2022) == before[0] and not files(2024) & before[1]
    assert store.row_count("daily_price") == 2 and store.compact("daily_price") == 0


def test_compaction_of_a_table_without_dates(spark, store):
    for n in range(3):
        rows = spark.createDataFrame([("A", float(n)), ("B", 1.0)] if n else [("A", 0.0)], "symbol string, price double")
        store.append("quote", rows, f"2024-02-01 1{n}:00:00", n)
    assert store.compact("quote") == 3 and store.row_count("quote") == 2
    assert {(r["symbol"], r["price"]) for r in store.read("quote").collect()} == {("A", 2.0), ("B", 1.0)}


@pytest.mark.parametrize("dated", [True, False])
def test_a_replay_after_a_compaction_adds_no_row(spark, store, price_rows, dated):
    table, key = ("daily_price", {"date": dt.date(2024, 1, 2)}) if dated else ("quote", {})
    field = "close" if dated else "price"
    kind = "date date, " if dated else ""

    def batch(n, **more):
        row = {"symbol": "A", **key, field: float(n), "_fetched_at": dt.datetime(2024, 2, 1, n), "_seq": n, **more}
        ddl = f"symbol string, {kind}{field} double, _fetched_at timestamp, _seq bigint"
        rows = spark.createDataFrame([row], ddl)
        spec = store.catalog[table]
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema() if f.name not in rows.columns]
        return rows.select("*", *empty)

    for n in range(3):
        store.put_batch(table, batch(n), "s", f"{n:03d}")
    store.put_batch(table, batch(1), "s", "001")  # two batches late, before the compaction
    assert store.row_count(table) == 3
    assert store.compact(table) == 2 and store.row_count(table) == 1
    for n in range(3):
        store.put_batch(table, batch(n), "s", f"{n:03d}")
    assert store.row_count(table) == 1 and store.read(table).first()[field] == 2.0
    store.put_batch(table, batch(5), "s", "005")
    store.put_batch(table, batch(0), "t", "000")  # another stream's batch of the same number
    assert store.row_count(table) == 3 and store.read(table).first()[field] == 5.0
    if dated:  # a year that the compaction left alone is still overwritten
        for _ in range(2):
            store.put_batch(table, batch(1, date=dt.date(2020, 1, 2)), "s", "001")
        assert store.row_count(table) == 4


def test_gaps_against_a_calendar(spark):
    from panelgrain.operators.versions import coverage_gaps

    days = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9, 10)]
    have = {"A": days, "B": days[1:3] + days[5:6], "C": [dt.date(2024, 1, 6)], "D": days[:1], "E": days[-1:]}
    rows = [(s, d) for s, ds in have.items() for d in ds + ds[:1]] + [(None, days[0]), ("A", None)]
    df = spark.createDataFrame(rows, "symbol string, date date")
    calendar = spark.createDataFrame([(d,) for d in days + days + [None]], "date date")

    def expected(symbols):
        out = set()
        for s in symbols:
            run = []
            for d in [*days, None]:
                if d is not None and d not in have.get(s, ()):
                    run.append(d)
                elif run:
                    out.add((s, run[0], run[-1], len(run)))
                    run = []
        return out

    assert {tuple(r) for r in coverage_gaps(df, calendar).collect()} == expected(have)
    asked = spark.createDataFrame([("B",), ("Z",), ("B",)], "symbol string")
    assert {tuple(r) for r in coverage_gaps(df, calendar, asked).collect()} == expected(["B", "Z"])
    assert coverage_gaps(df, calendar.limit(0), asked).count() == 0
    assert {tuple(r) for r in coverage_gaps(df.limit(0), calendar, asked).collect()} == expected(["Z"]) | {("B", days[0], days[-1], 7)}


def test_a_busy_day_of_events_is_joined_not_windowed(spark):
    from panelgrain.operators.versions import newest_load

    df = spark.range(2_000).select(F.lit("HOT").alias("symbol"), F.lit("2024-01-01").cast("date").alias("date"),
                                   F.timestamp_seconds(F.col("id") % 2).alias("_fetched_at"), F.lit("0").alias("_batch_id"), "id")
    out = newest_load(df, ["symbol", "date"])
    assert {r["id"] for r in out.collect()} == set(range(1, 2_000, 2))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_newest_load_keeps_equal_events_and_replaces_corrected_ones(spark, store):
    def trade(price, shares=1):
        return {"symbol": "A", "transactionDate": "2024-03-01", "acquisitionOrDisposition": "A",
                "securitiesTransacted": shares, "price": float(price)}

    frame = lambda rows: spark.createDataFrame(
        rows, "symbol string, transactionDate string, acquisitionOrDisposition string, securitiesTransacted bigint, price double")
    store.append("insider_trades", frame([trade(10), trade(7), trade(7)]), "2024-03-02", 1)
    store.append("insider_trades", frame([trade(20), trade(7), trade(7)]), "2024-03-03", 2)
    store.append("insider_trades", frame([dict(trade(500), transactionDate="2024-06-01")]), "2024-06-02", 3)
    store.append("daily_price", spark.createDataFrame([("A", "2024-03-05", 1.0)], "symbol string, date string, close double"))
    q = lambda: PanelQuery(store).symbols("A").select("insider_total_bought_90d").as_of("2024-03-31")
    assert q().execute().first()["insider_total_bought_90d"] == 34.0
    prices = store.scan("insider_trades", ["insider_price"], version_as_of="2024-03-02 12:00:00", whole_loads=True)
    assert sorted(r["insider_price"] for r in prices.collect()) == [7.0, 7.0, 10.0]
    plan = q().execute()._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-03-31" in plan and "2024-01-01" in plan
