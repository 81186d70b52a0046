"""Building blocks that several features share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..context import Builder, PanelView
from ..expr import growth, per_day, ratio


def of(top: str, bottom: str) -> Builder:
    """Plain ratio of two fields."""
    return lambda p: ratio(p[top], p[bottom])


def over(top: str, bottom: Builder) -> Builder:
    """Ratio of a field to a derived amount."""
    return lambda p: ratio(p[top], bottom(p))


def same(name: str) -> Builder:
    return lambda p: p[name]


def grows(name: str, k: int = 1) -> Builder:
    """Growth of a field against the row ``k`` earlier."""
    return lambda p: growth(p[name], p.lag(name, k))


def previous_ratio(p: PanelView, top: str, bottom: str) -> Column:
    return ratio(p.lag(top), p.lag(bottom))


def ratio_shift(top: str, bottom: str) -> Builder:
    """A ratio minus its value one row earlier."""
    return lambda p: ratio(p[top], p[bottom]) - previous_ratio(p, top, bottom)


def ratio_index(top: str, bottom: str) -> Builder:
    """A ratio relative to its value one row earlier."""
    return lambda p: ratio(ratio(p[top], p[bottom]), previous_ratio(p, top, bottom))


# -- statement amounts -----------------------------------------------------
def ebit(p: PanelView) -> Column:
    return p["ebitda"] - p["depreciation_and_amortization"]


def nopat(p: PanelView) -> Column:
    return p["operating_income"] * (1 - ratio(p["income_tax_expense"], p["income_before_tax"]))


def invested_capital(p: PanelView) -> Column:
    return p["total_debt"] + p["total_stockholders_equity"] - p["cash_and_equivalents"]


def working_capital(p: PanelView) -> Column:
    return p["total_current_assets"] - p["total_current_liabilities"]


def net_debt(p: PanelView) -> Column:
    return p["total_debt"] - p["cash_and_equivalents"]


def tangible_equity(p: PanelView) -> Column:
    return p["total_stockholders_equity"] - p["goodwill_and_intangibles"]


def non_current_base(p: PanelView) -> Column:
    return p["total_assets"] - p["total_current_liabilities"]


def capex_size(p: PanelView) -> Column:
    return F.abs(p["capex"])


def dividends_size(p: PanelView) -> Column:
    return F.abs(p["dividends_paid"])


def accruals(p: PanelView) -> Column:
    return ratio(p["net_income"] - p["operating_cash_flow"], p["total_assets"])


# -- turnover in days ------------------------------------------------------
def inventory_days(p: PanelView) -> Column:
    return ratio(p["inventory"], per_day(p["cost_of_revenue"]))


def receivable_days(p: PanelView) -> Column:
    return ratio(p["net_receivables"], per_day(p["revenue"]))


def payable_days(p: PanelView) -> Column:
    return ratio(p["accounts_payable"], per_day(p["cost_of_revenue"]))


def cash_cycle(p: PanelView) -> Column:
    return inventory_days(p) + receivable_days(p) - payable_days(p)


# -- indices against the previous row, shared by quality checks and scores --
receivables_index = ratio_index("net_receivables", "revenue")
expense_index = ratio_index("sga_expenses", "revenue")
leverage_index = ratio_index("total_liabilities", "total_assets")


def margin_index(p: PanelView) -> Column:
    return ratio(previous_ratio(p, "gross_profit", "revenue"), ratio(p["gross_profit"], p["revenue"]))


def soft_assets(total: Column, current: Column, fixed: Column) -> Column:
    """Share of assets that is neither current nor plant."""
    return ratio(total - current - fixed, total)


_SOFT = ("total_assets", "total_current_assets", "property_plant_equipment")


def asset_quality(p: PanelView) -> Column:
    return soft_assets(*p.cols(*_SOFT))


def asset_quality_index(p: PanelView) -> Column:
    return ratio(asset_quality(p), soft_assets(*[p.lag(c) for c in _SOFT]))


def sales_index(p: PanelView) -> Column:
    return ratio(p["revenue"], p.lag("revenue"))


def depreciation_rate(p: PanelView) -> Column:
    used, plant = p["depreciation_and_amortization"], p["property_plant_equipment"]
    return ratio(used, used + plant)


def previous_depreciation_rate(p: PanelView) -> Column:
    used, plant = p.lag("depreciation_and_amortization"), p.lag("property_plant_equipment")
    return ratio(used, used + plant)


def depreciation_index(p: PanelView) -> Column:
    return ratio(previous_depreciation_rate(p), depreciation_rate(p))


def surprise(actual: str, estimate: str) -> Builder:
    return lambda p: growth(p[actual], p[estimate])


# -- prices ----------------------------------------------------------------
def price_return(p: PanelView, k: int = 1) -> Column:
    """Return over ``k`` rows."""
    before = p.lag("close", k)
    return ratio(p["close"] - before, before)


def gross_return(p: PanelView, k: int = 1) -> Column:
    """The same return written as a price relative minus one."""
    return ratio(p["close"], p.lag("close", k)) - 1


def true_range(p: PanelView) -> Column:
    before = p.lag("close")
    return F.greatest(
        p["high"] - p["low"], F.abs(p["high"] - before), F.abs(p["low"] - before)
    )


def flow_multiplier(p: PanelView) -> Column:
    """Where in its range the day closed, from -1 to 1."""
    return ratio((p["close"] - p["low"]) - (p["high"] - p["close"]), p["high"] - p["low"])


def signed_volume(p: PanelView) -> Column:
    before = p.lag("close")
    return (
        F.when(p["close"] > before, p["volume"])
        .when(p["close"] < before, -p["volume"])
        .otherwise(0)
    )


def from_high(p: PanelView) -> Column:
    return ratio(p["year_high"] - p["price"], p["year_high"])


def from_low(p: PanelView) -> Column:
    return ratio(p["price"] - p["year_low"], p["year_low"])
