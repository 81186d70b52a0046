import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from panelgrain import FrameSource, PanelQuery
from panelgrain.functions.features import default_registry
from panelgrain.operators import recursive as R
from panelgrain.operators import rolling as RO

REGISTRY = default_registry()
START = dt.date(2024, 1, 1)


def series(spark, values, column="close", symbol="A"):
    rows = [(symbol, START + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"symbol string, date date, {column} double")


def query(source, *names):
    return PanelQuery(source, REGISTRY).all_symbols().select(*names)


# -- vector helpers ----------------------------------------------------------
def test_ema_first_values():
    got = R.ema(np.array([100.0, 104.0, 108.0]), 12)
    assert got == pytest.approx([100.0, 102.1667, 104.4434], abs=1e-4)


def test_ema_keeps_nulls_null():
    got = R.ema(np.array([1.0, np.nan, 3.0]), 3)
    assert math.isnan(got[1]) and got[2] == pytest.approx((3 + 0.25 * 1) / 1.25)


@settings(max_examples=40, deadline=None)
@given(hs.lists(hs.floats(-50, 50), min_size=1, max_size=60), hs.integers(2, 20))
def test_wilder_is_the_recursion(values, n):
    got = R.wilder(np.array(values), n)
    average = None
    for i, v in enumerate(values):
        if i + 1 < n:
            assert math.isnan(got[i])
            continue
        average = sum(values[:n]) / n if i + 1 == n else (average * (n - 1) + v) / n
        assert got[i] == pytest.approx(average, abs=1e-9)


@settings(max_examples=40, deadline=None)
@given(hs.lists(hs.one_of(hs.none(), hs.floats(-5, 5)), min_size=1, max_size=50), hs.integers(2, 12))
def test_rolls_against_brute_force(values, n):
    x = np.array([np.nan if v is None else v for v in values], dtype=float)
    rolls = {h: RO.Roll(h, ("x",), n) for h in ("stddev", "p05", "skew", "kurt", "count")}
    got = RO.compute({"x": x}, rolls)
    for i in range(len(x)):
        w = x[max(0, i - n + 1):i + 1]
        w = w[~np.isnan(w)]
        assert got["count"][i] == len(w)
        if len(w):
            assert got["p05"][i] == pytest.approx(np.quantile(w, 0.05), abs=1e-9)
        if len(w) >= 2:
            assert got["stddev"][i] == pytest.approx(np.std(w, ddof=1), abs=1e-9)
        spread = np.std(w) if len(w) else 0
        if len(w) >= 4 and spread > 1e-3:
            m, k = w.mean(), len(w)
            g1 = ((w - m) ** 3).mean() / spread**3
            g2 = ((w - m) ** 4).mean() / spread**4 - 3
            assert got["skew"][i] == pytest.approx(g1 * math.sqrt(k * (k - 1)) / (k - 2), abs=1e-6)
            assert got["kurt"][i] == pytest.approx(
                (k - 1) / ((k - 2) * (k - 3)) * ((k + 1) * g2 + 6), abs=1e-6)


def test_long_rolls_cross_blocks():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=5000), rng.normal(size=5000)
    got = RO.compute({"x": x, "y": y}, {
        "c": RO.Roll("corr", ("x", "y"), 252), "s": RO.Roll("stddev", ("x",), 252)})
    for i in (300, 2047, 2048, 2049, 4999):
        assert got["c"][i] == pytest.approx(np.corrcoef(x[i - 251:i + 1], y[i - 251:i + 1])[0, 1])
        assert got["s"][i] == pytest.approx(np.std(x[i - 251:i + 1], ddof=1))


# -- families -----------------------------------------------------------------
def test_macd(spark):
    closes = [100 + 5 * math.sin(i / 4) + 0.2 * i for i in range(60)]
    rows = query(FrameSource({"daily_price": series(spark, closes)}), "ema_12", "ema_26", "macd_line",
                 "macd_signal", "macd_histogram").ordered().collect()
    for r in rows:
        assert r["macd_line"] == pytest.approx(r["ema_12"] - r["ema_26"])
        assert r["macd_histogram"] == pytest.approx(r["macd_line"] - r["macd_signal"])
    assert rows[0]["ema_12"] == closes[0]


def test_dividend_streak(spark):
    values = [1.0, 1.1, 1.2, 1.2, None, 1.5, 1.6, 1.7, 1.0]
    df = series(spark, values, "adj_dividend")
    rows = query(FrameSource({"dividends_data": df}), "consecutive_dividend_increases").ordered().collect()
    assert [r["consecutive_dividend_increases"] for r in rows] == [0, 1, 2, 0, 0, 0, 1, 2, 0]


def test_beta_of_twice_the_market_is_two(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(0, 0.01, 300)
    index, stock = 100 * np.cumprod(1 + m), 50 * np.cumprod(1 + 2 * m)
    bench = series(spark, [float(v) for v in index]).drop("symbol")
    rows = query(FrameSource({"daily_price": series(spark, [float(v) for v in stock])}),
                 "beta_sp500", "alpha_jensen").using(benchmark=bench).ordered().collect()
    assert rows[59]["beta_sp500"] is None and rows[60]["beta_sp500"] == pytest.approx(2.0)
    expected = stock[-1] / stock[-253] - 1 - 2 * (index[-1] / index[-253] - 1)
    assert rows[-1]["alpha_jensen"] == pytest.approx(expected)


def test_benchmark_from_the_price_table(spark):
    rng = np.random.default_rng(3)
    index = 100 * np.cumprod(1 + rng.normal(0, 0.01, 80))
    both = series(spark, [float(v) for v in index], symbol="^GSPC").unionByName(
        series(spark, [float(v) for v in index], symbol="A"))
    rows = PanelQuery(FrameSource({"daily_price": both}), REGISTRY).symbols("A").select(
        "beta_sp500").ordered().collect()
    assert len(rows) == 80 and rows[-1]["beta_sp500"] == pytest.approx(1.0)


def test_membership_both_ways(spark):
    src = FrameSource({"daily_price": series(spark, [1.0]).unionByName(series(spark, [1.0], symbol="Z"))})
    members = spark.createDataFrame([("A",), ("A",)], "symbol string")
    rows = query(src, "close", "in_sp500").using(sp500_constituents=members).ordered().collect()
    assert [(r["symbol"], r["in_sp500"]) for r in rows] == [("A", 1), ("Z", 0)]
    with pytest.raises(ValueError, match="nasdaq_constituents"):
        query(src, "in_nasdaq").execute()


def test_insider_signals(spark):
    src = FrameSource({"daily_price": series(spark, [1.0]).unionByName(series(spark, [1.0], symbol="Z"))})
    d = dt.date
    trades = spark.createDataFrame(
        [("A", d(2024, 6, 20), "A", 100, 10.0, "x", "Officer"), ("A", d(2024, 6, 21), "A", 50, 10.0, "y", "o"),
         ("A", d(2024, 6, 22), "A", 10, 10.0, "z", "o"), ("A", d(2024, 5, 1), "D", 30, 20.0, "x", "o"),
         ("A", d(2023, 1, 1), "D", 999, 99.0, "x", "o")],
        "symbol string, date date, acquisition_or_disposition string, securities_transacted bigint, "
        "insider_price double, reporting_name string, type_of_owner string")
    names = ["insider_net_buying_90d", "insider_buy_count_30d", "insider_sell_count_30d",
             "insider_buy_sell_ratio_90d", "insider_buying_cluster", "insider_officer_buying"]
    rows = query(src, *names).as_of("2024-06-30").using(insider_events=trades).ordered().collect()
    assert [rows[0][n] for n in names] == [1000.0, 3, 0, 3.0, 1, 1]
    assert [rows[1][n] for n in names] == [0.0, 0, 0, None, 0, 0]


def test_senate_and_grades(spark):
    src = FrameSource({"daily_price": series(spark, [1.0])})
    d = dt.date
    senate = spark.createDataFrame(
        [("A", d(2024, 6, 1), "Purchase"), ("A", d(2024, 5, 30), "Sale (Partial)"),
         ("A", d(2024, 5, 29), "Purchase"), ("A", d(2020, 1, 1), "Purchase")],
        "symbol string, date date, type string")
    grades = spark.createDataFrame(
        [("A", d(2024, 6, 1), "upgrade"), ("A", d(2024, 6, 2), "Upgrade"), ("A", d(2024, 6, 3), "downgrade")],
        "symbol string, date date, action string")
    row = query(src, "senate_buy_count_90d", "senate_sell_count_90d", "senate_net_flow_90d",
                "senate_activity_flag", "upgrades_90d", "downgrades_90d", "upgrade_downgrade_ratio").as_of(
        "2024-06-30").using(senate_events=senate, grade_events=grades).execute().first()
    assert tuple(row)[2:] == (2, 1, 1, 1, 2, 1, 2.0)


def test_no_events_gives_the_defaults(spark):
    src = FrameSource({"daily_price": series(spark, [1.0])})
    none = spark.createDataFrame([], "symbol string, date date, action string")
    row = query(src, "upgrades_90d", "upgrade_downgrade_ratio").using(grade_events=none).execute().first()
    assert tuple(row)[2:] == (0, None)


def test_other_columns_pass_through_smoothing(spark):
    df = series(spark, [1.0, None, 3.0]).withColumn("note", F.lit("x"))
    out = R.with_indicators(df, {"e": R.indicator_ema(5)}, ["close"]).orderBy("date").collect()
    assert [r["note"] for r in out] == ["x"] * 3 and out[1]["e"] is None and out[1]["close"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(hs.integers(0, 40), hs.sampled_from("xyz")), max_size=20))
def test_trailing_signals_against_brute_force(spark, buys):
    from panelgrain.operators import signals as S

    def day(n):
        return START + dt.timedelta(days=n)

    events = spark.createDataFrame(
        [("A", day(d), "A", 1, 2.0, who, "o") for d, who in buys],
        "symbol string, date date, acquisition_or_disposition string, securities_transacted bigint, "
        "insider_price double, reporting_name string, type_of_owner string")
    wanted = S.pick(S.insider_signals(10, 4), ["insider_total_bought_90d", "insider_buy_count_30d",
                                               "insider_buying_cluster"])
    spine = series(spark, [0.0] * 45)
    for r in S.with_trailing_signals(spine, events, wanted).collect():
        n = (r["date"] - START).days
        assert r["insider_total_bought_90d"] == 2.0 * sum(n - 10 <= d <= n for d, _ in buys)
        assert r["insider_buy_count_30d"] == sum(n - 4 <= d <= n for d, _ in buys)
        assert r["insider_buying_cluster"] == (len({w for d, w in buys if n - 4 <= d <= n}) >= 3)


def test_trailing_through_the_query(spark):
    src = FrameSource({"daily_price": series(spark, [1.0, 1.0, 1.0])})
    grades = spark.createDataFrame([("A", START + dt.timedelta(days=1), "upgrade")],
                                   "symbol string, date date, action string")
    rows = query(src, "upgrades_90d").trailing().using(grade_events=grades).ordered().collect()
    assert [r["upgrades_90d"] for r in rows] == [0, 1, 1]


def test_worker_code_travels_with_the_tasks():
    from pyspark import cloudpickle

    assert {"panelgrain.operators.rolling", "panelgrain.operators.recursive", "panelgrain.streaming.ema"} \
        <= cloudpickle.list_registry_pickle_by_value()
