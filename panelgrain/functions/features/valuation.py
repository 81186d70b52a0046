"""Valuation multiples and composite scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..expr import flag, growth, points, ratio, weighted
from ..registry import FeatureRegistry
from . import parts as P
from .parts import of, over, previous_ratio, same


def _multiple(value, amount):
    """Market or enterprise value over a derived amount."""
    return over(value, amount)


def _expected_eps_growth(p):
    return growth(p["est_eps_avg"], p["eps_diluted"])


VALUATION = {
    "pe_derived": of("market_cap", "net_income"),
    "peg_ratio": lambda p: ratio(
        ratio(p["price"], p["eps_diluted"]), _expected_eps_growth(p) * 100
    ),
    "price_to_sales_derived": of("market_cap", "revenue"),
    "price_to_book": of("market_cap", "total_stockholders_equity"),
    "price_to_tangible_book": _multiple("market_cap", P.tangible_equity),
    "price_to_cf": of("market_cap", "operating_cash_flow"),
    "price_to_fcf": of("market_cap", "free_cash_flow"),
    "price_to_working_capital": _multiple("market_cap", P.working_capital),
    "ev_to_revenue": of("enterprise_value", "revenue"),
    "ev_to_ebitda_derived": of("enterprise_value", "ebitda"),
    "ev_to_ebit": _multiple("enterprise_value", P.ebit),
    "ev_to_fcf_derived": of("enterprise_value", "free_cash_flow"),
    "ev_to_ic": _multiple("enterprise_value", P.invested_capital),
    "ev_to_gross_profit": of("enterprise_value", "gross_profit"),
    "ev_per_share": of("enterprise_value", "weighted_avg_shares_diluted"),
    "earnings_yield_derived": of("net_income", "market_cap"),
    "fcf_yield_derived": of("free_cash_flow", "market_cap"),
    "shareholder_yield": lambda p: ratio(
        -p["share_repurchase"] - p["dividends_paid"], p["market_cap"]
    ),
    "tobins_q": lambda p: ratio(p["market_cap"] + p["total_liabilities"], p["total_assets"]),
    "dcf_value": same("dcf_val"),
    "dcf_upside": lambda p: ratio(p["dcf_val"] - p["price"], p["price"]),
    "dcf_margin_of_safety": lambda p: ratio(p["dcf_val"] - p["price"], p["dcf_val"]),
}

# Published coefficients of the scores, in the order of the measures.
ALTMAN = {
    "public": (1.2, 1.4, 3.3, 0.6, 1.0),
    "private": (0.717, 0.847, 3.107, 0.420, 0.998),
    "emerging": (6.56, 3.26, 6.72, 1.05),
}
ALTMAN_EMERGING_BASE = 3.25
BENEISH_BASE = -4.84
BENEISH = (0.920, 0.528, 0.404, 0.892, 0.115, -0.172, 4.679, -0.327)
OHLSON_BASE = -1.32
GRAHAM = 22.5


def altman_measures(p, cushion: str):
    """Altman's measures; ``cushion`` is the field set against liabilities."""
    assets = p["total_assets"]
    return [
        ratio(P.working_capital(p), assets),
        ratio(p["retained_earnings"], assets),
        ratio(P.ebit(p), assets),
        ratio(p[cushion], p["total_liabilities"]),
        ratio(p["revenue"], assets),
    ]


def altman(kind: str, cushion: str):
    return lambda p: weighted(*zip(ALTMAN[kind], altman_measures(p, cushion)))


def _altman_emerging(p):
    out = F.lit(ALTMAN_EMERGING_BASE)
    measures = altman_measures(p, "total_stockholders_equity")
    for weight, measure in zip(ALTMAN["emerging"], measures):
        out = out + F.lit(weight) * measure
    return out


BENEISH_INDICES = {
    "dsri": P.receivables_index,
    "gmi": P.margin_index,
    "aqi": P.asset_quality_index,
    "sgi": P.sales_index,
    "depi": P.depreciation_index,
    "sgai": P.expense_index,
    "tata": P.accruals,
    "lvgi": P.leverage_index,
}


def _beneish(p):
    out = F.lit(BENEISH_BASE)
    for weight, index in zip(BENEISH, BENEISH_INDICES.values()):
        out = out + F.lit(weight) * index(p)
    return out


def _rises(p, top, bottom):
    return ratio(p[top], p[bottom]) > previous_ratio(p, top, bottom)


def _falls(p, top, bottom):
    return ratio(p[top], p[bottom]) < previous_ratio(p, top, bottom)


def _piotroski(p):
    profitable = (
        p["net_income"] > 0,
        p["operating_cash_flow"] > 0,
        _rises(p, "net_income", "total_assets"),
        p["operating_cash_flow"] > p["net_income"],
    )
    sound = (
        _falls(p, "long_term_debt", "total_assets"),
        _rises(p, "total_current_assets", "total_current_liabilities"),
        p["weighted_avg_shares_diluted"] <= p.lag("weighted_avg_shares_diluted"),
    )
    efficient = (
        _rises(p, "gross_profit", "revenue"),
        _rises(p, "revenue", "total_assets"),
    )
    return points(*profitable, *sound, *efficient)


def _montier(p):
    diverging = (p["net_income"] > p.lag("net_income")) & (
        p["operating_cash_flow"] < p.lag("operating_cash_flow")
    )
    return points(
        diverging,
        _rises(p, "net_receivables", "revenue"),
        _rises(p, "inventory", "cost_of_revenue"),
        _rises(p, "other_current_assets", "revenue"),
        P.depreciation_rate(p) < P.previous_depreciation_rate(p),
        growth(p["total_assets"], p.lag("total_assets")) > 0.10,
    )


def _ohlson(p):
    assets, debts, income = p.cols("total_assets", "total_liabilities", "net_income")
    before = p.lag("net_income")
    swing = ratio(income - before, F.abs(income) + F.abs(before))
    terms = [
        (-0.407, F.ln(assets / F.lit(1_000_000.0))),
        (6.03, ratio(debts, assets)),
        (-1.43, ratio(P.working_capital(p), assets)),
        (0.076, ratio(p["total_current_liabilities"], p["total_current_assets"])),
        (-1.72, flag(debts > assets)),
        (-2.37, ratio(income, assets)),
        (-1.83, ratio(p["operating_cash_flow"], debts)),
        (0.285, flag((income < 0) & (before < 0))),
        (-0.521, swing),
    ]
    out = F.lit(OHLSON_BASE)
    for weight, term in terms:
        out = out + F.lit(weight) * term
    return out


def _graham(p):
    book = ratio(p["total_stockholders_equity"], p["outstanding_shares"])
    return F.sqrt(F.lit(GRAHAM) * F.abs(p["eps_diluted"]) * F.abs(book))


def _operating_base(p):
    return (
        p["property_plant_equipment"]
        + p["total_current_assets"]
        - p["total_current_liabilities"]
    )


COMPOSITE = {
    "altman_z_score": altman("public", "market_cap"),
    "altman_z_prime": altman("private", "total_stockholders_equity"),
    "altman_z_double_prime": _altman_emerging,
    "piotroski_f_score": _piotroski,
    **{f"beneish_{k}": index for k, index in BENEISH_INDICES.items()},
    "beneish_m_score": _beneish,
    "graham_number": _graham,
    "graham_margin_of_safety": lambda p: ratio(_graham(p) - p["price"], p["price"]),
    "earnings_yield_magic": lambda p: ratio(P.ebit(p), p["enterprise_value"]),
    "return_on_capital_magic": lambda p: ratio(P.ebit(p), _operating_base(p)),
    "acquirers_multiple": of("enterprise_value", "ebitda"),
    "montier_c_score": _montier,
    "ohlson_o_score": _ohlson,
}


def register(registry: FeatureRegistry) -> None:
    registry.add_all("valuation", VALUATION)
    registry.add_all("composite", COMPOSITE)
