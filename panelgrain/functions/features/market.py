"""Features of prices: risk, technical measures, momentum."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..expr import TRADING_DAYS, flag, ratio
from ..registry import FeatureRegistry
from . import parts as P

ANNUAL = math.sqrt(TRADING_DAYS)


def _returns(p):
    return p.define("ret1", P.gross_return(p))


def _down_moves(p):
    """One-row returns of losing rows only."""
    loss = F.when(p["close"] < p.lag("close"), P.price_return(p))
    return p.define("down1", loss)


def _down_relatives(p):
    loss = F.when(p["close"] < p.lag("close"), P.gross_return(p))
    return p.define("downrel1", loss)


def _volatility(n):
    return lambda p: p.roll("stddev", _returns(p), n) * ANNUAL


def _drawdown(p):
    peak = p.roll("max", "close", TRADING_DAYS)
    return ratio(p["close"] - peak, peak)


def _excess_return(p):
    return P.gross_return(p, TRADING_DAYS) - p["rate_10y"] / F.lit(100.0)


RISK = {
    "daily_return": P.price_return,
    **{f"historical_volatility_{n}d": _volatility(n) for n in (20, 60, TRADING_DAYS)},
    "max_drawdown_252d": _drawdown,
    "distance_from_52w_high": P.from_high,
    "distance_from_52w_low": P.from_low,
    "volume_to_avg": lambda p: ratio(p["quote_volume"], p["quote_volume"]),
    "price_range_pct": lambda p: ratio(p["high"] - p["low"], p["open"]),
    "overnight_gap": lambda p: ratio(p["open"] - p.lag("close"), p.lag("close")),
    "up_day": lambda p: flag(p["close"] > p.lag("close")),
    "true_range": P.true_range,
    "atr_14": lambda p: p.roll("avg", p.define("true_range", P.true_range(p)), 14),
    "down_volatility_20d": lambda p: p.roll("stddev", _down_moves(p), 20) * ANNUAL,
    "calmar_ratio": lambda p: ratio(P.gross_return(p, TRADING_DAYS), F.abs(_drawdown(p))),
    "var_95_252d": lambda p: p.roll("p05", _returns(p), TRADING_DAYS),
    "skewness_252d": lambda p: p.roll("skew", _returns(p), TRADING_DAYS),
    "kurtosis_252d": lambda p: p.roll("kurt", _returns(p), TRADING_DAYS),
    "sharpe_ratio_252d": lambda p: ratio(
        _excess_return(p), p.roll("stddev", _returns(p), TRADING_DAYS) * ANNUAL
    ),
    "sortino_ratio_252d": lambda p: ratio(
        _excess_return(p), p.roll("stddev", _down_relatives(p), TRADING_DAYS) * ANNUAL
    ),
}


def _sma(n):
    return lambda p: p.roll("avg", "close", n)


def _to_sma(n):
    return lambda p: ratio(p["close"], p.roll("avg", "close", n))


def _band(p, side):
    """Bollinger band: twenty-row mean plus ``side`` standard deviations."""
    mean, spread = p.roll("avg", "close", 20), p.roll("stddev", "close", 20)
    return mean + F.lit(float(side)) * spread


def _band_width(p):
    return F.lit(4.0) * p.roll("stddev", "close", 20)


def _flow_volume(p):
    return P.flow_multiplier(p) * p["volume"]


def _chaikin(p):
    flow = p.roll("sum", p.define("flow_volume", _flow_volume(p)), 20)
    return ratio(flow, p.roll("sum", "volume", 20))


TECHNICAL = {
    "distance_52w_high": P.from_high,
    "distance_52w_low": P.from_low,
    "candlestick_range": lambda p: ratio(p["high"] - p["low"], p["open"]),
    "intraday_return": lambda p: ratio(p["close"] - p["open"], p["open"]),
    "volume_rate_of_change": lambda p: ratio(p["volume"] - p.lag("volume"), p.lag("volume")),
    "force_index": lambda p: (p["close"] - p.lag("close")) * p["volume"],
    "obv_direction": lambda p: P.signed_volume(p).cast("double"),
    **{f"price_momentum_{k}d": (lambda k: lambda p: P.price_return(p, k))(k)
       for k in (5, 21, 63, 126, 252)},
    "rolling_high_20d": lambda p: p.roll("max", "high", 20),
    "rolling_low_20d": lambda p: p.roll("min", "low", 20),
    **{f"sma_{n}": _sma(n) for n in (20, 50, 200)},
    **{f"price_to_sma_{n}": _to_sma(n) for n in (20, 50, 200)},
    "sma_50_to_200": lambda p: ratio(_sma(50)(p), _sma(200)(p)),
    "golden_cross_flag": lambda p: flag(_sma(50)(p) > _sma(200)(p)),
    "bollinger_upper": lambda p: _band(p, 2),
    "bollinger_lower": lambda p: _band(p, -2),
    "bollinger_pct_b": lambda p: ratio(p["close"] - _band(p, -2), _band_width(p)),
    "bollinger_bandwidth": lambda p: ratio(_band_width(p), p.roll("avg", "close", 20)),
    "accumulation_distribution": _flow_volume,
    "money_flow_multiplier": P.flow_multiplier,
    "obv_cumulative": lambda p: p.roll(
        "sum", p.define("signed_volume", P.signed_volume(p)), None
    ).cast("bigint"),
    "chaikin_money_flow_20d": _chaikin,
}


def _volume_when(p, slot, condition):
    return p.roll("sum", p.define(slot, F.when(condition, p["volume"]).otherwise(0)), 20)


def _up_down_volume(p):
    before = p.lag("close")
    up = _volume_when(p, "volume_up", p["close"] > before)
    down = _volume_when(p, "volume_down", p["close"] <= before)
    return ratio(up, down)


def _share_of_gains(p):
    rose = F.when(p["close"] - p.lag("close") > 0, 1.0).otherwise(0.0)
    return ratio(p.roll("sum", p.define("rose", rose), TRADING_DAYS), F.lit(float(TRADING_DAYS)))


def _month_ago_return(p, start):
    """Return from ``start`` rows ago up to 21 rows ago."""
    return ratio(p.lag("close", 21) - p.lag("close", start), p.lag("close", start))


def _reversal(p):
    return -P.price_return(p, 5)


MOMENTUM = {
    **{f"return_{k}d": (lambda k: lambda p: P.price_return(p, k))(k)
       for k in (1, 5, 21, 63, 126, 252)},
    "momentum_12_1": lambda p: _month_ago_return(p, 252),
    "percentile_52w": lambda p: ratio(p["price"] - p["year_low"], p["year_high"] - p["year_low"]),
    "short_term_reversal": _reversal,
    "mean_reversion_5d": _reversal,
    "volume_price_confirmation": lambda p: (
        P.price_return(p) * ratio(p["volume"], p["quote_volume"])
    ),
    "acceleration": lambda p: P.price_return(p, 21) - _month_ago_return(p, 42),
    "up_down_volume_ratio_20d": _up_down_volume,
    "frog_in_pan": _share_of_gains,
}


def register(registry: FeatureRegistry) -> None:
    registry.add_all("risk", RISK)
    registry.add_all("technical", TECHNICAL)
    registry.add_all("momentum", MOMENTUM)
