"""Features of the financial statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..expr import compound, flag, growth, per_day, ratio
from ..registry import FeatureRegistry
from . import parts as P
from .parts import grows, of, over, ratio_shift, same

PROFITABILITY = {
    "gross_profit_margin": of("gross_profit", "revenue"),
    "operating_profit_margin": of("operating_income", "revenue"),
    "net_profit_margin": of("net_income", "revenue"),
    "ebitda_margin": of("ebitda", "revenue"),
    "ebit_margin": lambda p: ratio(P.ebit(p), p["revenue"]),
    "return_on_assets": of("net_income", "total_assets"),
    "return_on_equity": of("net_income", "total_stockholders_equity"),
    "roic_derived": lambda p: ratio(P.nopat(p), P.invested_capital(p)),
    "roce": lambda p: ratio(P.ebit(p), P.non_current_base(p)),
    "return_on_tangible_assets": lambda p: ratio(
        p["net_income"], p["total_assets"] - p["goodwill_and_intangibles"]
    ),
    "return_on_net_assets": over("net_income", P.non_current_base),
    "operating_return_on_assets": of("operating_income", "total_assets"),
    "cash_return_on_assets": of("operating_cash_flow", "total_assets"),
    "cash_return_on_ic": over("operating_cash_flow", P.invested_capital),
    "effective_tax_rate": of("income_tax_expense", "income_before_tax"),
    "tax_burden_ratio": of("net_income", "income_before_tax"),
    "interest_burden_ratio": of("income_before_tax", "operating_income"),
    "nopat": P.nopat,
    # A flat 10 % stands in for the cost of capital.
    "economic_profit_proxy": lambda p: P.nopat(p) - 0.10 * P.invested_capital(p),
    "roic_wacc_spread": lambda p: ratio(P.nopat(p), P.invested_capital(p)) - 0.10,
}

LIQUIDITY = {
    "current_ratio_derived": of("total_current_assets", "total_current_liabilities"),
    "quick_ratio": lambda p: ratio(
        p["total_current_assets"] - p["inventory"], p["total_current_liabilities"]
    ),
    "cash_ratio": lambda p: ratio(
        p["cash_and_equivalents"] + p["short_term_investments"], p["total_current_liabilities"]
    ),
    "working_capital": P.working_capital,
    "working_capital_to_revenue": lambda p: ratio(P.working_capital(p), p["revenue"]),
    "nwc_to_total_assets": lambda p: ratio(P.working_capital(p), p["total_assets"]),
    "defensive_interval": lambda p: ratio(
        p["cash_and_equivalents"] + p["short_term_investments"] + p["net_receivables"],
        per_day(p["operating_expenses"]),
    ),
    "cash_conversion_cycle": P.cash_cycle,
    "ocf_ratio": of("operating_cash_flow", "total_current_liabilities"),
    "net_debt_derived": P.net_debt,
    "net_debt_to_ebitda": lambda p: ratio(P.net_debt(p), p["ebitda"]),
    "cash_burn_rate": lambda p: p["operating_cash_flow"] / F.lit(12.0),
    "cash_runway_months": lambda p: ratio(
        p["cash_and_equivalents"], -p["operating_cash_flow"] / F.lit(12.0)
    ),
}


def _debt_service(p):
    return p["interest_expense"] + p["debt_repayment"]


def _sensitivity(name):
    """Growth of an income line per unit of revenue growth."""
    def build(p):
        moved = growth(p[name], p.lag(name))
        sales = growth(p["revenue"], p.lag("revenue"))
        idle = (p.lag(name) == 0) | (p.lag("revenue") == 0)
        return F.when(idle, None).otherwise(ratio(moved, sales))
    return build


LEVERAGE = {
    "debt_to_equity_derived": of("total_debt", "total_stockholders_equity"),
    "debt_to_assets_derived": of("total_debt", "total_assets"),
    "equity_multiplier": of("total_assets", "total_stockholders_equity"),
    "lt_debt_to_cap": lambda p: ratio(
        p["long_term_debt"], p["long_term_debt"] + p["total_stockholders_equity"]
    ),
    "interest_coverage": lambda p: ratio(P.ebit(p), p["interest_expense"]),
    "ebitda_interest_coverage": of("ebitda", "interest_expense"),
    "cf_coverage": of("operating_cash_flow", "interest_expense"),
    "fixed_charge_coverage": lambda p: ratio(P.ebit(p) + p["interest_expense"], _debt_service(p)),
    "debt_service_coverage": over("operating_cash_flow", _debt_service),
    "financial_leverage_dfl": lambda p: ratio(P.ebit(p), P.ebit(p) - p["interest_expense"]),
    "operating_leverage_dol": _sensitivity("operating_income"),
    "combined_leverage_dtl": _sensitivity("net_income"),
    "net_debt_to_equity": lambda p: ratio(P.net_debt(p), p["total_stockholders_equity"]),
    "tangible_net_worth": P.tangible_equity,
    "debt_to_tangible_nw": over("total_debt", P.tangible_equity),
    "interest_income_to_expense": of("interest_income", "interest_expense"),
    "net_interest_margin": lambda p: ratio(
        p["interest_income"] - p["interest_expense"], p["total_assets"]
    ),
}

EFFICIENCY = {
    "asset_turnover_derived": of("revenue", "total_assets"),
    "fixed_asset_turnover": of("revenue", "property_plant_equipment"),
    "inventory_turnover": of("cost_of_revenue", "inventory"),
    "dio": P.inventory_days,
    "receivables_turnover": of("revenue", "net_receivables"),
    "dso": P.receivable_days,
    "payables_turnover": of("cost_of_revenue", "accounts_payable"),
    "dpo": P.payable_days,
    "ccc": P.cash_cycle,
    "working_capital_turnover": over("revenue", P.working_capital),
    "equity_turnover": of("revenue", "total_stockholders_equity"),
    "capital_turnover": over("revenue", P.invested_capital),
    "revenue_per_employee": of("revenue", "employee_count_val"),
    "net_income_per_employee": of("net_income", "employee_count_val"),
    "opex_ratio": of("operating_expenses", "revenue"),
    "sga_to_revenue": of("sga_expenses", "revenue"),
    "rd_to_revenue": of("rd_expenses", "revenue"),
    "rd_to_gross_profit": of("rd_expenses", "gross_profit"),
    "capex_to_revenue": lambda p: ratio(P.capex_size(p), p["revenue"]),
    "capex_to_depreciation": lambda p: ratio(P.capex_size(p), p["depreciation_and_amortization"]),
}

CASH_FLOW = {
    "fcf_derived": lambda p: p["operating_cash_flow"] + p["capex"],
    "fcf_margin": of("free_cash_flow", "revenue"),
    "cash_earnings_quality": of("operating_cash_flow", "net_income"),
    "cash_debt_coverage": of("operating_cash_flow", "total_debt"),
    "ocf_to_capex": over("operating_cash_flow", P.capex_size),
    "capex_to_ocf": lambda p: ratio(P.capex_size(p), p["operating_cash_flow"]),
    "reinvestment_rate": lambda p: ratio(
        P.capex_size(p) - p["depreciation_and_amortization"], P.nopat(p)
    ),
    "cash_conversion_ratio": of("free_cash_flow", "net_income"),
    "ocf_growth": grows("operating_cash_flow"),
    "capex_growth": grows("capex"),
    "sloan_ratio": P.accruals,
    "fcf_to_revenue": of("free_cash_flow", "revenue"),
    "fcf_per_share_derived": of("free_cash_flow", "weighted_avg_shares_diluted"),
    "dividends_to_fcf": lambda p: ratio(P.dividends_size(p), p["free_cash_flow"]),
}


def _cagr(name, k, signed=True):
    if signed:
        return lambda p: compound(p[name], p.lag(name, k), k)
    return lambda p: compound(F.abs(p[name]), F.abs(p.lag(name, k)), k)


def _capital_spending_growth(p):
    return growth(P.capex_size(p), F.abs(p.lag("capex")))


def _revenue_growth_spread(p):
    step = p.define("revenue_step", growth(p["revenue"], p.lag("revenue")))
    return p.roll("stddev", step, 5)


GROWTH = {
    "revenue_growth_yoy": grows("revenue"),
    "gross_profit_growth": grows("gross_profit"),
    "operating_income_growth": grows("operating_income"),
    "ebitda_growth": grows("ebitda"),
    "net_income_growth": grows("net_income"),
    "eps_growth_yoy": grows("eps_diluted"),
    "fcf_growth": grows("free_cash_flow"),
    "asset_growth": grows("total_assets"),
    "book_value_growth": grows("total_stockholders_equity"),
    "sustainable_growth_rate": lambda p: (
        ratio(p["net_income"], p["total_stockholders_equity"])
        * (1 - ratio(P.dividends_size(p), p["net_income"]))
    ),
    "sequential_revenue_growth": grows("revenue"),
    "operating_margin_change": ratio_shift("operating_income", "revenue"),
    "net_margin_change": ratio_shift("net_income", "revenue"),
    "debt_to_equity_change": ratio_shift("total_debt", "total_stockholders_equity"),
    "current_ratio_change": ratio_shift("total_current_assets", "total_current_liabilities"),
    "capex_growth_rate": _capital_spending_growth,
    "rd_growth": grows("rd_expenses"),
    "sga_growth": grows("sga_expenses"),
    "working_capital_change": lambda p: P.working_capital(p) - (
        p.lag("total_current_assets") - p.lag("total_current_liabilities")
    ),
    "share_count_change": grows("weighted_avg_shares_diluted"),
    "market_cap_growth": grows("market_cap"),
    "revenue_growth_consistency": _revenue_growth_spread,
    **{f"revenue_cagr_{k}y": _cagr("revenue", k) for k in (3, 5, 10)},
    **{f"eps_cagr_{k}y": _cagr("eps_diluted", k, signed=False) for k in (3, 5, 10)},
    **{f"dividend_growth_{k}y": _cagr("adj_dividend", k) for k in (3, 5)},
}

_STEPS = {
    "tax": of("net_income", "income_before_tax"),
    "interest": of("income_before_tax", "operating_income"),
    "margin": of("operating_income", "revenue"),
    "turnover": of("revenue", "total_assets"),
    "multiplier": of("total_assets", "total_stockholders_equity"),
}


def _roe_in_five_steps(p):
    out = None
    for step in _STEPS.values():
        out = step(p) if out is None else out * step(p)
    return out


DUPONT = {
    "tax_burden": _STEPS["tax"],
    "interest_burden": _STEPS["interest"],
    "dupont_operating_margin": _STEPS["margin"],
    "dupont_asset_turnover": _STEPS["turnover"],
    "dupont_equity_multiplier": _STEPS["multiplier"],
    "roe_3factor": lambda p: (
        ratio(p["net_income"], p["revenue"]) * _STEPS["turnover"](p) * _STEPS["multiplier"](p)
    ),
    "roe_5factor": _roe_in_five_steps,
}


def _build_up(name):
    """Change of a balance per unit of revenue change."""
    return lambda p: ratio(p[name] - p.lag(name), p["revenue"] - p.lag("revenue"))


def _beat_streak(p):
    beat = p.define("eps_beat", flag(p["earnings_eps"] > p["eps_estimated"]))
    return p.roll("sum", beat, 4).cast("int")


EARNINGS_QUALITY = {
    "sloan_accrual_cf": P.accruals,
    "total_accruals_to_assets": P.accruals,
    "cash_to_accruals": of("operating_cash_flow", "net_income"),
    "receivables_pct_revenue": of("net_receivables", "revenue"),
    "delta_receivables_revenue": _build_up("net_receivables"),
    "inventory_pct_revenue": of("inventory", "revenue"),
    "delta_inventory_revenue": _build_up("inventory"),
    "deferred_revenue_growth": grows("deferred_revenue"),
    "goodwill_to_assets": of("goodwill_and_intangibles", "total_assets"),
    "goodwill_impairment_flag": lambda p: flag(p["goodwill"] < p.lag("goodwill")),
    "asset_quality": P.asset_quality,
    "earnings_surprise": P.surprise("earnings_eps", "eps_estimated"),
    "revenue_surprise": P.surprise("earnings_revenue", "revenue_estimated"),
    "ocf_exceeds_ni": lambda p: flag(p["operating_cash_flow"] > p["net_income"]),
    "dsri": P.receivables_index,
    "gmi": P.margin_index,
    "earnings_surprise_streak": _beat_streak,
}

PER_SHARE = {
    "eps_basic_derived": of("net_income", "weighted_avg_shares"),
    "eps_diluted_derived": of("net_income", "weighted_avg_shares_diluted"),
    "bvps": of("total_stockholders_equity", "outstanding_shares"),
    "tbvps": lambda p: ratio(P.tangible_equity(p), p["outstanding_shares"]),
    "revenue_per_share_derived": of("revenue", "outstanding_shares"),
    "ocf_per_share": of("operating_cash_flow", "outstanding_shares"),
    "fcf_per_share": of("free_cash_flow", "outstanding_shares"),
    "dividend_per_share": same("adj_dividend"),
    "net_cash_per_share": lambda p: ratio(
        p["cash_and_equivalents"] - p["total_debt"], p["outstanding_shares"]
    ),
    "ev_per_share_derived": of("enterprise_value", "outstanding_shares"),
    "share_dilution_rate": grows("weighted_avg_shares_diluted"),
}


def _buyback_size(p):
    return F.abs(p["share_repurchase"])


DIVIDEND = {
    "trailing_dividend_yield": lambda p: ratio(p["adj_dividend"] * 4, p["price"]),
    "dividend_payout_ratio": of("adj_dividend", "eps_diluted"),
    "fcf_payout_ratio": lambda p: ratio(P.dividends_size(p), p["free_cash_flow"]),
    "dividend_coverage": of("eps_diluted", "adj_dividend"),
    "buyback_yield": lambda p: ratio(_buyback_size(p), p["market_cap"]),
    "shareholder_yield_total": lambda p: ratio(
        P.dividends_size(p) + _buyback_size(p), p["market_cap"]
    ),
    "dividend_growth": grows("adj_dividend"),
    "net_issuance_rate": grows("weighted_avg_shares_diluted"),
    "dividends_to_net_income": lambda p: ratio(P.dividends_size(p), p["net_income"]),
    "total_shareholder_return_proxy": lambda p: (
        P.price_return(p) + ratio(p["adj_dividend"], p["close"])
    ),
    "dividend_cagr_5y": _cagr("adj_dividend", 5),
}


def register(registry: FeatureRegistry) -> None:
    for category, builders in {
        "profitability": PROFITABILITY,
        "liquidity": LIQUIDITY,
        "leverage": LEVERAGE,
        "efficiency": EFFICIENCY,
        "cash_flow": CASH_FLOW,
        "growth": GROWTH,
        "dupont": DUPONT,
        "earnings_quality": EARNINGS_QUALITY,
        "per_share": PER_SHARE,
        "dividend": DIVIDEND,
    }.items():
        registry.add_all(category, builders)
