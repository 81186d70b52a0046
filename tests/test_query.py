import datetime as dt

import pytest

from panelgrain import FrameSource, Grain, PanelQuery
from panelgrain.functions.features import default_registry
from panelgrain.functions.registry import FeatureRegistry
from panelgrain.plans.query import discover

REGISTRY = default_registry()
D = dt.date.fromisoformat


def frame(spark, ddl, rows):
    return spark.createDataFrame(
        [tuple(D(v) if isinstance(v, str) and v[:2] in ("19", "20") and v[4:5] == "-" else v
               for v in r) for r in rows], ddl)


@pytest.fixture
def source(spark):
    prices = frame(
        spark, "symbol string, date date, open double, high double, low double, close double, volume bigint",
        [("A", "2024-01-15", 180.0, 185.0, 179.0, 180.0, 50_000_000),
         ("A", "2024-01-16", 183.0, 186.0, 182.0, 185.0, 48_000_000),
         ("B", "2024-01-15", 10.0, 11.0, 9.0, 10.0, 5),
         ("B", "2024-01-16", 10.0, 12.0, 10.0, 11.0, 6)])
    income = frame(
        spark, "symbol string, date date, period string, revenue bigint, gross_profit bigint, net_income bigint",
        [("A", "2023-09-30", "FY", 383_285_000_000, 100, 50),
         ("A", "2024-01-16", "Q1", 119_000_000_000, 120, 60)])
    rates = frame(spark, "date date, rate_2y double, rate_10y double",
                  [("2024-01-15", 4.38, 4.12), ("2024-01-16", 4.0, 4.2)])
    quote = frame(spark, "symbol string, price double, year_high double, year_low double",
                  [("A", 185.0, 200.0, 100.0)])
    return FrameSource({"daily_price": prices, "income_statement": income,
                        "treasury_rates": rates, "quote": quote})


def q(source, *fields):
    return PanelQuery(source, REGISTRY).symbols("A").select(*fields)


def test_validation(source):
    with pytest.raises(ValueError, match="no symbols"):
        PanelQuery(source, REGISTRY).select("close").execute()
    with pytest.raises(ValueError, match="no fields"):
        PanelQuery(source, REGISTRY).symbols("A").execute()
    with pytest.raises(ValueError, match="unknown field"):
        q(source, "no_such").execute()
    with pytest.raises(ValueError, match="roll-up"):
        q(source, "close").agg(close="mode")


def test_carry_forward_of_one_statement(source):
    rows = q(source, "close", "revenue").date_range("2024-01-01", "2024-01-15").ordered().collect()
    assert [r["revenue"] for r in rows] == [383_285_000_000]
    rows = q(source, "close", "revenue").ordered().collect()
    # A statement of the same day already counts.
    assert [r["revenue"] for r in rows] == [383_285_000_000, 119_000_000_000]


def test_carry_left_and_inner(source):
    every = PanelQuery(source, REGISTRY).all_symbols().select("close", "revenue")
    assert every.execute().count() == 4
    inner = PanelQuery(source, REGISTRY).all_symbols().select("close", "revenue").carry("inner")
    assert {r["symbol"] for r in inner.execute().collect()} == {"A"}


def test_quarterly_roll_up(source):
    row = q(source, "open", "high", "low", "close", "volume").grain("quarterly").execute().first()
    assert row["date"] == D("2024-01-01") and row["volume"] == 98_000_000
    assert (row["open"], row["high"], row["low"], row["close"]) == (180.0, 186.0, 179.0, 185.0)


def test_rolled_prices_meet_native_statements(source):
    rows = q(source, "volume", "revenue").grain(Grain.QUARTERLY).execute().collect()
    assert [(r["volume"], r["revenue"]) for r in rows] == [(98_000_000, 119_000_000_000)]


def test_agg_override(source):
    row = q(source, "close", "volume").grain("monthly").agg(close="mean", volume="count").execute().first()
    assert row["close"] == 182.5 and row["volume"] == 2


def test_first_lag_is_null(source):
    rows = q(source, "return_1d").ordered().collect()
    assert rows[0]["return_1d"] is None
    assert rows[1]["return_1d"] == pytest.approx(5 / 180)


def test_warm_up(source):
    rows = q(source, "return_1d").date_range("2024-01-16", None).execute().collect()
    assert [r["return_1d"] for r in rows] == [None]
    rows = q(source, "return_1d").date_range("2024-01-16", None).warm_up().execute().collect()
    assert rows[0]["return_1d"] == pytest.approx(5 / 180)
    near = q(source, "return_1d").date_range("2024-01-16", None).warm_up(days=1).execute()
    assert near.first()["return_1d"] == pytest.approx(5 / 180)
    assert "2024-01-15" in near._jdf.queryExecution().optimizedPlan().toString()


def test_date_only_table(source):
    rows = q(source, "yield_spread_2s10s", "yield_curve_inverted").execute().orderBy("date").collect()
    assert rows[0].asDict() == {"date": D("2024-01-15"), "yield_spread_2s10s": pytest.approx(-0.26),
                                "yield_curve_inverted": 1}
    rows = q(source, "close", "rate_10y").ordered().collect()
    assert [r["rate_10y"] for r in rows] == [4.12, 4.2]


def test_date_only_selected_first_does_not_become_the_spine(source):
    rows = q(source, "rate_10y", "close").ordered().collect()
    assert [(r["symbol"], r["rate_10y"]) for r in rows] == [("A", 4.12), ("A", 4.2)]


def test_snapshot_join_and_snapshot_only(source):
    rows = q(source, "close", "price", "distance_52w_high").execute().collect()
    assert {r["price"] for r in rows} == {185.0}
    alone = q(source, "price", "near_52w_low").execute()
    assert alone.columns == ["symbol", "price", "near_52w_low"] and alone.count() == 1
    with pytest.raises(ValueError, match="snapshot"):
        q(source, "close").grain("snapshot").execute()


def test_alias_keeps_the_requested_name(spark):
    ratios = frame(spark, "symbol string, date date, period string, price_earnings_ratio double",
                   [("A", "2024-03-31", "Q1", 20.0)])
    df = PanelQuery(FrameSource({"ratios": ratios}), REGISTRY).symbols("A").select("pe_ratio", "pe_ratio")
    assert df.execute().columns == ["symbol", "date", "pe_ratio"]


def test_feature_named_like_a_stored_field(spark):
    income = frame(spark, "symbol string, date date, period string, gross_profit bigint, revenue bigint",
                   [("A", "2024-03-31", "Q1", 40, 100)])
    df = PanelQuery(FrameSource({"income_statement": income}), REGISTRY).symbols("A")
    assert df.select("gross_profit_margin").execute().first()["gross_profit_margin"] == 0.4


def test_full_year_and_quarter_on_one_date(spark):
    income = frame(spark, "symbol string, date date, period string, revenue bigint",
                   [("A", "2023-12-31", "FY", 400), ("A", "2023-12-31", "Q4", 100)])
    src = FrameSource({"income_statement": income})
    one = PanelQuery(src, REGISTRY).symbols("A").select("revenue").execute().collect()
    assert [r["revenue"] for r in one] == [100]
    year = PanelQuery(src, REGISTRY).symbols("A").select("revenue").period("annual").execute()
    assert year.first()["revenue"] == 400


def test_explicit_spine_and_inputs(source):
    rows = q(source, "close", "net_profit_margin").grain("quarterly").spine("income_statement").with_inputs()
    got = rows.ordered().collect()
    assert [r["date"] for r in got] == [D("2023-09-30"), D("2024-01-16")]
    assert got[0]["close"] is None and got[1]["close"] == 185.0
    assert got[1]["net_income"] == 60


def test_native_grain_features(source):
    plain = q(source, "close", "revenue_growth_yoy").ordered().collect()
    native = q(source, "close", "revenue_growth_yoy").native().ordered().collect()
    # Row lags see the carried statement; native lags see the previous statement.
    change = (119 - 383.285) / 383.285
    assert plain[1]["revenue_growth_yoy"] == pytest.approx(change)
    assert native[0]["revenue_growth_yoy"] is None
    assert native[1]["revenue_growth_yoy"] == pytest.approx(change)


def test_tables_in_one_frame_are_scanned_once(spark, source):
    wide = source.frames["income_statement"].selectExpr(
        "*", "revenue * 2 AS total_assets", "revenue AS operating_cash_flow")
    src = FrameSource({"income_statement": wide, "balance_sheet": wide, "cash_flow": wide})
    df = PanelQuery(src, REGISTRY).symbols("A").select("return_on_assets", "cash_return_on_assets").execute()
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 2


def test_custom_features(spark, source):
    registry = FeatureRegistry()

    @registry.feature("spread", "mine")
    def spread(p):
        return p["high"] - p["low"]

    @registry.panel("doubling", "mine", ["close"], ["twice_close"])
    def doubling(df, names, inputs):
        return df.withColumn(names[0], df["close"] * 2)

    rows = PanelQuery(source, registry).symbols("A").select("spread", "twice_close").ordered().collect()
    assert [(r["spread"], r["twice_close"]) for r in rows] == [(6.0, 360.0), (4.0, 370.0)]
    found = {r["feature"]: r["reads"] for r in discover(spark, registry, "mine").collect()}
    assert found == {"spread": ["high", "low"], "twice_close": ["close"]}


def test_symbols_from_a_frame(spark, source):
    wanted = spark.createDataFrame([("B",), ("B",)], "symbol string")
    rows = PanelQuery(source, REGISTRY).symbols(wanted).select("close").execute().collect()
    assert {r["symbol"] for r in rows} == {"B"} and len(rows) == 2


def test_one_exchange_by_symbol_serves_carry_windows_and_smoothing(source):
    df = q(source, "close", "revenue", "return_1d", "sma_20", "ema_12").execute()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol#") - plan.count("symbol#, date#") <= 3
    assert plan.count("FlatMapGroupsInArrow") == 1


def test_calendar_lags(spark, source):
    income = frame(spark, "symbol string, date date, period string, revenue bigint",
                   [("A", "2022-03-31", "Q1", 100), ("A", "2022-12-31", "Q4", 70), ("A", "2023-03-28", "Q1", 120),
                    ("A", "2024-03-31", "Q1", 90)])
    src = FrameSource({"income_statement": income})
    df = PanelQuery(src, REGISTRY).symbols("A").select("revenue_growth_yoy").lag_by("calendar")
    assert [r[2] for r in df.ordered().collect()] == [None, None, pytest.approx(0.2), pytest.approx(-0.25)]
    with pytest.raises(ValueError, match="calendar"):
        q(source, "return_1d").lag_by("calendar").execute()


def test_spine_sets_the_default_grain(source):
    got = q(source, "volume", "revenue").spine("income_statement").ordered().collect()
    assert [(r["date"], r["volume"]) for r in got] == [(D("2023-09-30"), None), (D("2024-01-16"), 98_000_000)]
    with pytest.raises(ValueError, match="lacks"):
        q(source, "close").spine("treasury_rates").execute()


def test_benchmark_is_rolled_with_the_panel(spark):
    closes = [100 + (i * 37 % 11) + i * 0.1 for i in range(600)]
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i), c) for s in ("A", "^GSPC") for i, c in enumerate(closes)]
    src = FrameSource({"daily_price": spark.createDataFrame(rows, "symbol string, date date, close double")})
    df = PanelQuery(src, REGISTRY).symbols("A").select("beta_sp500").grain("weekly")
    assert df.ordered().collect()[-1]["beta_sp500"] == pytest.approx(1.0)


def _history(spark, store):
    """Prices of 2023 and 2024, and coarser tables with versions, periods that share a date, and gaps."""
    days = [dt.date(2023, 1, 2) + dt.timedelta(days=3 * k) for k in range(200)]
    prices = [(s, str(d), float(k)) for s in ("A", "B", "C") for k, d in enumerate(days)]
    store.append("daily_price", spark.createDataFrame(prices, "symbol string, date string, close double"), "2024-05-01")
    ddl = "symbol string, date string, period string, revenue bigint"
    quarters = ["2022-12-31", "2023-03-31", "2023-06-30", "2023-09-30", "2023-12-31", "2024-02-10", "2024-03-31"]
    for load in range(2):
        rows = [(s, d, f"Q{k % 4 + 1}", 100 * k + load) for s in ("A", "B") for k, d in enumerate(quarters) if (s, k) != ("B", 4)]
        rows += [("A", d, "FY", 9_000 + load) for d in ("2022-12-31", "2023-12-31")] + [("C", "2023-12-31", None, 5), ("C", "2023-12-31", "Q2", 6)]
        store.append("income_statement", spark.createDataFrame(rows, ddl), f"2024-06-0{load + 1} 10:00:00", load)
    staff = [("A", "2022-12-31", 7), ("B", "2021-12-31", 8), ("B", "2024-01-31", None)]
    store.append("employee_count", spark.createDataFrame(staff, "symbol string, date string, employeeCount int"), "2024-05-01")


@pytest.mark.parametrize("setup", [
    {}, {"grain": "weekly"}, {"grain": "monthly"}, {"carry": "inner"}, {"period": "quarter"}, {"period": "annual"},
    {"version_as_of": "2024-06-01 12:00:00"}, {"warm_up": 30},
], ids=str)
def test_a_seeded_carry_equals_a_carry_of_all_history(spark, store, setup, monkeypatch):
    _history(spark, store)

    def rows():
        q = PanelQuery(store).symbols("A", "B", "C").select("close", "revenue", "employee_count_val")
        for name, value in setup.items():
            getattr(q, name)(value)
        return sorted(map(tuple, q.date_range("2024-02-14", "2024-06-30").execute().collect()), key=repr)

    seeded = rows()
    monkeypatch.setattr(PanelQuery, "_carried", lambda self, spec, columns, target: self._scan(spec, columns, None))
    assert seeded == rows() and seeded


def test_early_rows_are_reduced_to_one_a_symbol_before_the_union(spark, store):
    _history(spark, store)
    df = PanelQuery(store).all_symbols().select("close", "revenue").date_range("2024-02-14").execute()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union"):]
    assert "max_by" in union and "Aggregate [symbol" in union and "date#" in union
    assert union.count("2024-02-14") >= 2  # below it for the seeds, from it on for the rest
