"""Feature values on hand-built rows, computed by hand or by plain Python."""

import datetime as dt
import math
import statistics as st

import pytest

from panelgrain import FrameSource, PanelQuery
from panelgrain.functions.features import default_registry

REGISTRY = default_registry()
START = dt.date(2023, 1, 2)


def prices(spark, closes, symbol="A"):
    rows = [(symbol, START + dt.timedelta(days=i), c * 0.99, c * 1.02, c * 0.97, float(c), 1000 + 10 * i)
            for i, c in enumerate(closes)]
    return spark.createDataFrame(
        rows, "symbol string, date date, open double, high double, low double, close double, volume bigint")


def run(source, *names):
    df = PanelQuery(source, REGISTRY).all_symbols().select(*names).as_of("2024-06-30").ordered()
    return df.collect()


def daily(spark, closes, *names):
    return run(FrameSource({"daily_price": prices(spark, closes)}), *names)


def statements(spark, *rows):
    """Rows of {field: value}; one wide frame for all three statements."""
    names = sorted({k for r in rows for k in r})
    data = [("A", START + dt.timedelta(days=91 * i), *[r.get(n) for n in names]) for i, r in enumerate(rows)]
    def kind(n):
        return "double" if n.startswith("eps") or n == "adj_dividend" else "bigint"
    wide = spark.createDataFrame(
        data, "symbol string, date date, " + ", ".join(f"{n} {kind(n)}" for n in names))
    return {t: wide for t in ("income_statement", "balance_sheet", "cash_flow", "key_metrics",
                              "dividends_data")}


CLOSES = [100 + 7 * math.sin(i / 3.0) + i * 0.3 for i in range(40)]


def test_margins(spark):
    row = run(FrameSource(statements(spark, {
        "revenue": 100, "gross_profit": 40, "net_income": 20, "operating_income": 30, "ebitda": 35})),
        "gross_profit_margin", "net_profit_margin", "operating_profit_margin", "ebitda_margin")[0]
    assert [row[i] for i in range(2, 6)] == [0.40, 0.20, 0.30, 0.35]


def test_zero_denominator_is_null(spark):
    row = run(FrameSource(statements(spark, {"revenue": 0, "gross_profit": 40})), "gross_profit_margin")[0]
    assert row["gross_profit_margin"] is None


BALANCE = {
    "total_current_assets": 500, "total_current_liabilities": 200, "total_assets": 1000,
    "retained_earnings": 300, "ebitda": 180, "depreciation_and_amortization": 30, "market_cap": 2400,
    "total_liabilities": 400, "revenue": 900, "total_stockholders_equity": 600, "net_income": 90,
    "operating_cash_flow": 110, "total_debt": 250, "cash_and_equivalents": 80,
    "operating_income": 140, "income_tax_expense": 25, "income_before_tax": 125,
}


def test_altman(spark):
    row = run(FrameSource(statements(spark, BALANCE)), "altman_z_score", "altman_z_prime",
              "altman_z_double_prime")[0]
    assert row["altman_z_score"] == pytest.approx(
        1.2 * 0.3 + 1.4 * 0.3 + 3.3 * 0.15 + 0.6 * 6 + 0.9)
    assert row["altman_z_prime"] == pytest.approx(
        0.717 * 0.3 + 0.847 * 0.3 + 3.107 * 0.15 + 0.42 * 1.5 + 0.998 * 0.9)
    assert row["altman_z_double_prime"] == pytest.approx(
        3.25 + 6.56 * 0.3 + 3.26 * 0.3 + 6.72 * 0.15 + 1.05 * 1.5)


def test_returns_on_capital(spark):
    row = run(FrameSource(statements(spark, BALANCE)), "roic_derived", "nopat",
              "economic_profit_proxy", "roe_3factor", "roe_5factor")[0]
    nopat, capital = 140 * (1 - 25 / 125), 250 + 600 - 80
    assert row["nopat"] == pytest.approx(nopat)
    assert row["roic_derived"] == pytest.approx(nopat / capital)
    assert row["economic_profit_proxy"] == pytest.approx(nopat - 0.1 * capital)
    assert row["roe_3factor"] == pytest.approx(90 / 600)
    assert row["roe_5factor"] == pytest.approx(90 / 600)


def test_piotroski_counts_nine_points(spark):
    before = {"net_income": 50, "total_assets": 1000, "operating_cash_flow": 60, "long_term_debt": 300,
              "total_current_assets": 300, "total_current_liabilities": 200,
              "weighted_avg_shares_diluted": 100, "gross_profit": 300, "revenue": 900}
    after = dict(before, net_income=80, operating_cash_flow=100, long_term_debt=250,
                 total_current_assets=350, gross_profit=380, revenue=1000)
    rows = run(FrameSource(statements(spark, before, after)), "piotroski_f_score")
    # On the first row only the three conditions without a predecessor can hold.
    assert [r["piotroski_f_score"] for r in rows] == [3, 9]


def test_growth_and_cagr(spark):
    rows = run(FrameSource(statements(spark, *[{"revenue": v} for v in (100, -50, 80, 133, 146, 161)])),
               "revenue_growth_yoy", "revenue_cagr_3y", "revenue_growth_consistency")
    assert rows[0]["revenue_growth_yoy"] is None
    assert rows[2]["revenue_growth_yoy"] == pytest.approx(130 / 50)
    assert rows[3]["revenue_cagr_3y"] == pytest.approx((133 / 100) ** (1 / 3) - 1)
    steps = [-1.5, 2.6, 53 / 80, 13 / 133, 15 / 146]
    assert rows[5]["revenue_growth_consistency"] == pytest.approx(st.stdev(steps))


def test_beneish_without_change_is_the_base_sum(spark):
    row = {**BALANCE, "net_receivables": 100, "gross_profit": 300, "property_plant_equipment": 200,
           "sga_expenses": 60}
    rows = run(FrameSource(statements(spark, row, row)), "beneish_m_score", "beneish_dsri", "beneish_tata")
    tata = (90 - 110) / 1000
    assert rows[0]["beneish_m_score"] is None and rows[1]["beneish_dsri"] == 1.0
    expected = -4.84 + 0.92 + 0.528 + 0.404 + 0.892 + 0.115 - 0.172 + 4.679 * tata - 0.327
    assert rows[1]["beneish_m_score"] == pytest.approx(expected)


def test_moving_average_and_bands(spark):
    rows = daily(spark, CLOSES, "sma_20", "bollinger_upper", "bollinger_lower", "bollinger_pct_b")
    last20 = CLOSES[-20:]
    mean, sd = st.mean(last20), st.stdev(last20)
    assert rows[-1]["sma_20"] == pytest.approx(mean)
    assert rows[-1]["bollinger_upper"] == pytest.approx(mean + 2 * sd)
    assert rows[-1]["bollinger_pct_b"] == pytest.approx((CLOSES[-1] - mean + 2 * sd) / (4 * sd))
    assert all(r["bollinger_lower"] < r["sma_20"] < r["bollinger_upper"] for r in rows[1:])
    assert rows[0]["sma_20"] == CLOSES[0] and rows[0]["bollinger_upper"] is None


def test_volatility_drawdown_and_range(spark):
    rows = daily(spark, CLOSES, "historical_volatility_20d", "max_drawdown_252d", "true_range", "atr_14",
                 "down_volatility_20d")
    rets = [b / a - 1 for a, b in zip(CLOSES, CLOSES[1:])]
    assert rows[-1]["historical_volatility_20d"] == pytest.approx(st.stdev(rets[-20:]) * math.sqrt(252))
    losses = [r for r in rets[-20:] if r < 0]
    assert rows[-1]["down_volatility_20d"] == pytest.approx(st.stdev(losses) * math.sqrt(252))
    peak = max(CLOSES)
    assert rows[-1]["max_drawdown_252d"] == pytest.approx((CLOSES[-1] - peak) / peak)
    ranges = [max(c * 1.02 - c * 0.97, *([abs(c * 1.02 - p), abs(c * 0.97 - p)] if p else [0]))
              for p, c in zip([None, *CLOSES], CLOSES)]
    assert rows[5]["true_range"] == pytest.approx(ranges[5])
    assert rows[-1]["atr_14"] == pytest.approx(st.mean(ranges[-14:]))


def test_volume_flow(spark):
    rows = daily(spark, CLOSES, "obv_cumulative", "up_day", "chaikin_money_flow_20d", "frog_in_pan")
    obv, seen = 0, None
    for i, c in enumerate(CLOSES):
        obv += 0 if seen is None or c == seen else (1000 + 10 * i) * (1 if c > seen else -1)
        assert rows[i]["obv_cumulative"] == obv
        assert rows[i]["up_day"] == int(seen is not None and c > seen)
        seen = c
    multiplier = ((1 - 0.97) - (1.02 - 1)) / (1.02 - 0.97)
    assert rows[-1]["chaikin_money_flow_20d"] == pytest.approx(multiplier)
    gains = sum(b > a for a, b in zip(CLOSES, CLOSES[1:]))
    assert rows[-1]["frog_in_pan"] == pytest.approx(gains / 252)


def test_risk_free_adjusted_ratios(spark):
    closes = [100 * 1.001 ** i * (1 + 0.01 * math.sin(i)) for i in range(260)]
    day = prices(spark, closes)
    rates = day.selectExpr("date", "4.0D AS rate_10y")
    rows = run(FrameSource({"daily_price": day, "treasury_rates": rates}), "sharpe_ratio_252d", "calmar_ratio")
    rets = [b / a - 1 for a, b in zip(closes, closes[1:])]
    excess = closes[-1] / closes[-253] - 1 - 0.04
    assert rows[-1]["sharpe_ratio_252d"] == pytest.approx(excess / (st.stdev(rets[-252:]) * math.sqrt(252)))
    assert rows[251]["sharpe_ratio_252d"] is None


def test_insider_rows(spark):
    rows = spark.createDataFrame(
        [("A", START, "A", 10, 2.0, "officer: CFO"), ("B", START, "D", 5, 3.0, "10 percent owner")],
        "symbol string, date date, acquisition_or_disposition string, securities_transacted bigint, "
        "insider_price double, type_of_owner string")
    got = run(FrameSource({"insider_trades": rows}), "insider_net_flow", "insider_shares_bought",
              "insider_is_officer")
    assert [(r[2], r[3], r[4]) for r in got] == [(20.0, 10, 1), (-15.0, 0, 0)]


def test_ipo_age_uses_the_given_day(spark):
    rows = spark.createDataFrame([("A", dt.date(2024, 6, 1))], "symbol string, ipo_date date")
    assert run(FrameSource({"profile": rows}), "ipo_age_days")[0]["ipo_age_days"] == 29


def test_every_feature_runs_on_an_empty_panel(spark):
    from panelgrain import default_catalog

    catalog = default_catalog()
    tables = {t for f in REGISTRY.features.values() for n in f.deps for t in [catalog.resolve(n)[0]]}
    empty = {t: spark.createDataFrame([], catalog[t].schema()) for t in tables}
    for category in REGISTRY.categories():
        names = [f.name for f in REGISTRY.features.values() if f.category == category]
        if names:
            df = PanelQuery(FrameSource(empty), REGISTRY).all_symbols().select(names).execute()
            assert set(names) <= set(df.columns)
    df = PanelQuery(FrameSource(empty), REGISTRY).all_symbols().select("return_1d", "ema_12", "kurtosis_252d")
    assert df.execute().collect() == []
