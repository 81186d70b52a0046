"""Panel features (P01–P30): registration of the families the query builder knows.

Inputs a family may need, by name:

``benchmark``       prices of the reference index (date, close)
``*_constituents``  member lists (symbol)
``insider_events``  insider trades, one row per trade
``senate_events``   senate trades (symbol, date, type)
``grade_events``    analyst grade changes (symbol, date, action)
``as_of``           the day recent windows end on (Column)
``trailing``        whether they end on each row's own date instead
"""

from __future__ import annotations

from ..functions.registry import FeatureRegistry
from . import recursive as R
from . import signals as S
from .align import membership_flag
from .market import with_autocorrelation, with_beta_alpha, with_rise_streak

SPANS = (12, 20, 26, 50, 200)
SMOOTHED = {**{f"ema_{n}": R.indicator_ema(n) for n in SPANS}, **R.MACD}

# Which member list answers which flag.
MEMBER_LISTS = {
    "in_sp500": "sp500_constituents",
    "in_nasdaq": "nasdaq_constituents",
    "in_dowjones": "dowjones_constituents",
}

INSIDER = (
    "insider_net_buying_90d", "insider_buy_count_30d", "insider_sell_count_30d",
    "insider_buy_sell_ratio_90d", "insider_buying_cluster", "insider_total_bought_90d",
    "insider_total_sold_90d", "insider_officer_buying",
)
SENATE = (
    "senate_buy_count_90d", "senate_sell_count_90d", "senate_net_flow_90d",
    "senate_activity_flag",
)
GRADES = ("upgrades_90d", "downgrades_90d", "upgrade_downgrade_ratio")


def register(registry: FeatureRegistry) -> None:
    @registry.panel("smoothing", "technical", ["close"], list(SMOOTHED))
    def smoothing(df, names, inputs):
        return R.with_indicators(df, {n: SMOOTHED[n] for n in names}, ["close"])

    @registry.panel("autocorrelation", "momentum", ["close"], ["return_autocorrelation_21d"])
    def autocorrelation(df, names, inputs):
        return with_autocorrelation(df, names[0])

    @registry.panel(
        "dividend_streak", "dividend", ["adj_dividend"], ["consecutive_dividend_increases"]
    )
    def dividend_streak(df, names, inputs):
        return with_rise_streak(df, "adj_dividend", names[0])

    @registry.panel(
        "market", "risk", ["close"], ["beta_sp500", "alpha_jensen"], needs=["benchmark"]
    )
    def market(df, names, inputs):
        return with_beta_alpha(df, inputs["benchmark"], names)

    for flag_name, members in MEMBER_LISTS.items():
        @registry.panel(flag_name, "index_membership", [], [flag_name], needs=[members])
        def membership(df, names, inputs, members=members):
            return membership_flag(df, inputs[members], names[0])

    for family, category, table, names_of, build in (
        ("insider_signals", "insider", "insider_events", INSIDER, S.insider_signals),
        ("senate_signals", "senate", "senate_events", SENATE, S.senate_signals),
        ("grade_signals", "analyst", "grade_events", GRADES, S.grade_signals),
    ):
        @registry.panel(family, category, [], names_of, needs=[table])
        def signals(df, names, inputs, table=table, build=build):
            wanted = S.pick(build(), names)
            if inputs["trailing"]:
                return S.with_trailing_signals(df, inputs[table], wanted)
            return S.with_signals(df, inputs[table], wanted, inputs["as_of"])
