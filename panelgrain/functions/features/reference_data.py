"""Features of analyst, macro, event, ESG, ownership and daily valuation data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..expr import flag, growth, ratio
from ..registry import FeatureRegistry
from . import parts as P
from .parts import grows, of, same, surprise
from .valuation import altman

# Points given to each recommendation, best first.
GRADE_POINTS = {"strong_buy": 5, "buy": 4, "hold": 3, "sell": 2, "strong_sell": 1}


def _recommendations(p, prefix=""):
    return p.cols(*[prefix + g for g in GRADE_POINTS])


def _total(columns):
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def _grade_average(prefix=""):
    def build(p):
        counts = _recommendations(p, prefix)
        earned = _total([c * w for c, w in zip(counts, GRADE_POINTS.values())])
        return ratio(earned, _total(counts))
    return build


def _grade_share(*grades):
    def build(p):
        part = _total(p.cols(*[f"hist_{g}" for g in grades]))
        return ratio(part, _total(_recommendations(p, "hist_")))
    return build


ANALYST = {
    "earnings_surprise_pct": surprise("earnings_eps", "eps_estimated"),
    "revenue_surprise_pct": surprise("earnings_revenue", "revenue_estimated"),
    "eps_surprise_direction": lambda p: (
        F.when(p["earnings_eps"] > p["eps_estimated"], 1)
        .when(p["earnings_eps"] < p["eps_estimated"], -1)
        .otherwise(0)
    ),
    "revenue_beat": lambda p: flag(p["earnings_revenue"] > p["revenue_estimated"]),
    "target_upside": lambda p: ratio(p["target_consensus"] - p["price"], p["price"]),
    "target_dispersion": lambda p: ratio(p["target_high"] - p["target_low"], p["target_median"]),
    "consensus_score": _grade_average(),
    "analyst_coverage": same("num_analysts_eps"),
    "est_eps_growth": lambda p: growth(p["est_eps_avg"], p["eps_diluted"]),
    "est_revenue_growth": lambda p: growth(p["est_revenue_avg"], p["revenue"]),
    "forward_pe": of("price", "est_eps_avg"),
    "provider_rating_val": same("provider_rating_score"),
}


def _spread(long, short):
    return lambda p: p[long] - p[short]


def _as_fraction(rate):
    return lambda p: p[rate] / F.lit(100.0)


MACRO = {
    "yield_10y": same("rate_10y"),
    "yield_2y": same("rate_2y"),
    "yield_spread_2s10s": _spread("rate_10y", "rate_2y"),
    "yield_curve_slope": _spread("rate_30y", "rate_3m"),
    "yield_spread_10y_3m": _spread("rate_10y", "rate_3m"),
    "risk_free_rate": _as_fraction("rate_10y"),
    "short_rate": _as_fraction("rate_3m"),
    "long_rate": _as_fraction("rate_30y"),
    "yield_curve_inverted": lambda p: flag(p["rate_2y"] > p["rate_10y"]),
}

# Within five percent of the yearly extreme.
NEAR = 0.05

EVENT_DRIVEN = {
    "ipo_age_days": lambda p: F.datediff(p.as_of, p["ipo_date"]),
    "near_52w_high": lambda p: flag(P.from_high(p) < NEAR),
    "near_52w_low": lambda p: flag(P.from_low(p) < NEAR),
    "float_pct": of("float_shares", "outstanding_shares"),
    "employee_growth": grows("employee_count_val"),
    **{f"provider_ret_{span}": same(f"provider_return_{span}")
       for span in ("1d", "5d", "1m", "3m", "6m", "ytd", "1y", "3y", "5y")},
    "split_ratio": of("split_numerator", "split_denominator"),
}

ESG = {
    "esg_composite": same("esg_score"),
    "esg_env": same("esg_environmental"),
    "esg_soc": same("esg_social"),
    "esg_gov": same("esg_governance"),
}


def _change_share(change, previous):
    """Reported change relative to the magnitude of the previous amount."""
    return lambda p: ratio(p[change], F.abs(p[previous]))


INSTITUTIONAL = {
    "inst_holders": same("inst_holders_count"),
    "inst_holders_delta": same("inst_holders_change"),
    "inst_invested": same("inst_total_invested"),
    "inst_invested_delta": same("inst_invested_change"),
    "inst_put_call": same("inst_put_call_ratio"),
    "inst_holders_growth": _change_share("inst_holders_change", "inst_holders_prev"),
    "inst_invested_growth": _change_share("inst_invested_change", "inst_invested_prev"),
}


def _daily_ev(p):
    return p["hist_market_cap"] + p["total_debt"] - p["cash_and_equivalents"]


def _ev_over(name):
    return lambda p: ratio(_daily_ev(p), p[name])


def _implied_growth(change, level):
    """Change relative to the level it came from."""
    return lambda p: ratio(p[change], F.abs(p[level] - p[change]))


HISTORICAL = {
    "hist_shares_outstanding": of("hist_market_cap", "close"),
    "hist_pe_daily": of("hist_market_cap", "net_income"),
    "hist_ps_daily": of("hist_market_cap", "revenue"),
    "hist_pb_daily": of("hist_market_cap", "total_stockholders_equity"),
    "hist_ev_daily": _daily_ev,
    "hist_ev_to_ebitda_daily": _ev_over("ebitda"),
    "hist_ev_to_revenue_daily": _ev_over("revenue"),
    "hist_ev_to_fcf_daily": _ev_over("free_cash_flow"),
    "hist_earnings_yield_daily": of("net_income", "hist_market_cap"),
    "hist_fcf_yield_daily": of("free_cash_flow", "hist_market_cap"),
    "hist_market_cap_growth": grows("hist_market_cap"),
    "hist_dividend_yield_daily": lambda p: ratio(P.dividends_size(p), p["hist_market_cap"]),
    "hist_altman_z_daily": altman("public", "hist_market_cap"),
    "hist_consensus_score": _grade_average("hist_"),
    "hist_buy_pct": _grade_share("strong_buy", "buy"),
    "hist_sell_pct": _grade_share("sell", "strong_sell"),
    "hist_analyst_count": lambda p: _total(_recommendations(p, "hist_")),
    "hist_inst_ownership_growth": _implied_growth("hist_inst_holders_change", "hist_inst_holders"),
    "hist_inst_investment_growth": _implied_growth(
        "hist_inst_invested_change", "hist_inst_invested"
    ),
}


def _acquired(p):
    return p["acquisition_or_disposition"] == "A"


def _disposed(p):
    return p["acquisition_or_disposition"] == "D"


def _trade_value(p):
    return p["insider_price"] * p["securities_transacted"]


def _where(side, amount):
    return lambda p: F.when(side(p), amount(p)).otherwise(0)


def _net_flow(p):
    return (
        F.when(_acquired(p), _trade_value(p)).when(_disposed(p), -_trade_value(p)).otherwise(0)
    )


def _senior(p):
    owner = p["type_of_owner"]
    return flag(owner.like("%officer%") | owner.like("%director%"))


INSIDER = {
    "insider_trade_value": _trade_value,
    "insider_buy_value": _where(_acquired, _trade_value),
    "insider_sell_value": _where(_disposed, _trade_value),
    "insider_net_flow": _net_flow,
    "insider_shares_bought": _where(_acquired, same("securities_transacted")),
    "insider_shares_sold": _where(_disposed, same("securities_transacted")),
    "insider_is_officer": _senior,
}


def register(registry: FeatureRegistry) -> None:
    for category, builders in {
        "analyst": ANALYST,
        "macro": MACRO,
        "event_driven": EVENT_DRIVEN,
        "esg": ESG,
        "institutional": INSTITUTIONAL,
        "historical": HISTORICAL,
        "insider": INSIDER,
    }.items():
        registry.add_all(category, builders)
