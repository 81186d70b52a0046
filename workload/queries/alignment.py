"""Projection, filters, grain alignment and roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain import Grain
from panelgrain.functions.registry import FeatureRegistry
from panelgrain.operators.asof import carry_forward_rows

from .. import oracle as O
from .. import views as V


def _r(*names):
    return ", ".join(f"{O.r6(n)} AS {n}" for n in names)


# -- J02 and the flagship ----------------------------------------------------
def j02_flagship(spark, sf_dir):
    """Daily close, newest earlier revenue, price/sales and one-day return."""
    registry = FeatureRegistry()
    registry.features.update(V.registry().features)
    registry.add("custom", "price_to_sales_now",
                 lambda p: F.try_divide(p["close"] * p["weighted_avg_shares_diluted"], p["revenue"]))
    q = V.PanelQuery(V.source(spark, sf_dir), registry).all_symbols()
    return V.rounded(q.select("close", "revenue", "price_to_sales_now", "return_1d").execute())


J02 = f"""
SELECT symbol, date, {_r("close")}, revenue,
       {O.r6("close * weighted_avg_shares_diluted / nullif(revenue, 0)")} AS price_to_sales_now,
       {O.r6("close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1")} AS return_1d
FROM (SELECT s.symbol, s.date, close, revenue, weighted_avg_shares_diluted
      FROM daily s ASOF LEFT JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.date)"""


def j02_inner(spark, sf_dir):
    q = V.query(spark, sf_dir).select("close", "revenue", "total_assets", "employee_count_val")
    return V.rounded(q.carry("inner").execute())


J02_INNER = f"""
SELECT s.symbol, s.date, {_r("close")}, revenue, total_assets, employee_count_val
FROM daily s ASOF JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.date
     ASOF JOIN annual a ON s.symbol = a.symbol AND s.date >= a.date"""


def j02_event_rows(spark, sf_dir):
    """Events with the user's value of three days or more ago: a non-unique left side."""
    days = V.event_days(spark, sf_dir).select(
        "symbol", F.date_add("date", 3).alias("date"), F.col("close").alias("earlier")
    )
    left = V.events(spark, sf_dir).select("symbol", "date", "event_id")
    return V.rounded(carry_forward_rows(left, [(days, ["earlier"])]))


J02_ROWS = f"""
SELECT e.symbol, e.date, event_id, {O.r6("close")} AS earlier
FROM ev e ASOF LEFT JOIN (SELECT symbol, date + 3 AS date, close FROM event_days) d
     ON e.symbol = d.symbol AND e.date >= d.date"""


def j02_native(spark, sf_dir):
    """Statement growth at its own grain, then carried to days."""
    q = V.query(spark, sf_dir).select("close", "revenue_growth_yoy", "net_margin_change").native()
    return V.rounded(q.execute())


J02_NATIVE = f"""
SELECT s.symbol, s.date, {_r("close", "revenue_growth_yoy", "net_margin_change")}
FROM daily s ASOF LEFT JOIN (
    SELECT symbol, date, (revenue - lag(revenue) OVER w) / nullif(abs(lag(revenue) OVER w), 0)
               AS revenue_growth_yoy,
           net_income / revenue - lag(net_income / revenue) OVER w AS net_margin_change
    FROM quarterly WINDOW w AS (PARTITION BY symbol ORDER BY date)) q
    ON s.symbol = q.symbol AND s.date >= q.date"""


# -- Q01–Q07 -------------------------------------------------------------------
def q01_symbols(spark, sf_dir):
    """A symbol set given as a DataFrame: semi join."""
    q = V.PanelQuery(V.source(spark, sf_dir), V.registry()).symbols(V.members(spark, sf_dir))
    return V.rounded(q.select("open", "close").execute())


Q01 = f"SELECT symbol, date, {_r('open', 'close')} FROM daily WHERE symbol IN (SELECT symbol FROM members)"


def q02_select(spark, sf_dir):
    """Base field, alias of nothing stored twice, row feature, window feature, panel feature."""
    q = V.query(spark, sf_dir).select("close", ["volume", "return_5d"]).select("shares_outstanding")
    return V.rounded(q.select("close", "candlestick_range").execute())


Q02 = f"""
SELECT symbol, date, {_r("close")}, volume,
       {O.r6("close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY date) - 1")} AS return_5d,
       outstanding_shares AS shares_outstanding, {O.r6("(high - low) / open")} AS candlestick_range
FROM daily JOIN snapshot USING (symbol)"""


def q03_date_range(spark, sf_dir):
    q = V.query(spark, sf_dir).select("close", "revenue", "return_1d")
    return V.rounded(q.date_range("1997-02-01", "1999-06-30").execute())


Q03 = f"""
SELECT symbol, date, {_r("close")}, revenue,
       {O.r6("close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1")} AS return_1d
FROM (SELECT s.symbol, s.date, close, revenue
      FROM daily s ASOF LEFT JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.date
      WHERE s.date BETWEEN DATE '1997-02-01' AND DATE '1999-06-30')"""


def q03_seeded_carry(spark, sf_dir):
    """A start amid quarters and years: what lies before it is one row per symbol and table."""
    q = V.query(spark, sf_dir).select("close", "revenue", "employee_count_val", "hist_hold")
    return V.rounded(q.date_range("1997-02-17", "1998-11-05").grain("weekly").execute())


Q03_SEEDED = f"""
SELECT w.symbol, w.date, {_r("close")}, revenue, employee_count_val, hist_hold
FROM (SELECT symbol, CAST(date_trunc('week', date) AS DATE) AS date, last(close ORDER BY date) AS close
      FROM daily WHERE date BETWEEN DATE '1997-02-17' AND DATE '1998-11-05' GROUP BY 1, 2) w
     ASOF LEFT JOIN quarterly q ON w.symbol = q.symbol AND w.date >= q.date
     ASOF LEFT JOIN annual a ON w.symbol = a.symbol AND w.date >= a.date
     ASOF LEFT JOIN monthly m ON w.symbol = m.symbol AND w.date >= m.date"""


def q03_warm_up(spark, sf_dir):
    """Lags see rows before the start; the result starts on it."""
    q = V.query(spark, sf_dir).select("close", "return_21d").warm_up()
    return V.rounded(q.date_range("1997-02-01", "1999-06-30").execute())


Q03_WARM = f"""
SELECT symbol, date, {_r("close", "return_21d")}
FROM (SELECT symbol, date, close,
             close / lag(close, 21) OVER (PARTITION BY symbol ORDER BY date) - 1 AS return_21d
      FROM daily)
WHERE date BETWEEN DATE '1997-02-01' AND DATE '1999-06-30'"""


def q05_default_grain(spark, sf_dir):
    """Quarterly and annual tables only: the quarter is the finest grain."""
    return V.query(spark, sf_dir).select("revenue", "employee_count_val", "sector").execute()


Q05 = """
SELECT s.symbol, s.date, revenue, employee_count_val, sector
FROM quarterly s ASOF LEFT JOIN annual a ON s.symbol = a.symbol AND s.date >= a.date
     LEFT JOIN snapshot n ON s.symbol = n.symbol"""


def q06_agg_override(spark, sf_dir):
    q = V.query(spark, sf_dir).select("close", "volume", "high").grain("monthly")
    return V.rounded(q.agg(close="mean", volume="max", high="median").execute())


Q06 = f"""
SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS date, {O.r6("avg(close)")} AS close,
       max(volume) AS volume, {O.r6("median(high)")} AS high
FROM daily GROUP BY 1, 2"""


def q06_calendar_lags(spark, sf_dir):
    """Growth against the same quarter of earlier years instead of earlier rows."""
    q = V.query(spark, sf_dir).select("revenue_growth_yoy", "revenue_cagr_3y", "net_margin_change")
    return V.rounded(q.lag_by("calendar").execute())


Q06_CALENDAR = f"""
SELECT a.symbol, a.date, {O.r6("(a.revenue - b.revenue) / nullif(abs(b.revenue), 0)")} AS revenue_growth_yoy,
       {O.r6("pow(a.revenue / nullif(c.revenue, 0), 1.0 / 3) - 1")} AS revenue_cagr_3y,
       {O.r6("a.net_income / a.revenue - b.net_income / b.revenue")} AS net_margin_change
FROM quarterly a
LEFT JOIN quarterly b ON a.symbol = b.symbol AND date_diff('quarter', b.date, a.date) = 4
LEFT JOIN quarterly c ON a.symbol = c.symbol AND date_diff('quarter', c.date, a.date) = 12"""


# -- J01, J03–J05 --------------------------------------------------------------
def j01_explicit_spine(spark, sf_dir):
    """Quarters as rows although daily prices are selected at a coarser grain."""
    q = V.query(spark, sf_dir).select("close", "volume", "revenue").grain("quarterly")
    return V.rounded(q.spine("income_statement").execute())


J01 = f"""
SELECT q.symbol, q.date, {_r("close")}, volume, revenue
FROM quarterly q LEFT JOIN
     (SELECT symbol, date_trunc('quarter', date) AS period, last(close ORDER BY date) AS close,
             CAST(sum(volume) AS BIGINT) AS volume FROM daily GROUP BY 1, 2) d
     ON q.symbol = d.symbol AND date_trunc('quarter', q.date) = d.period"""


def j03_rolled_and_native(spark, sf_dir):
    """Daily prices rolled to quarters meet quarterly statements."""
    q = V.query(spark, sf_dir).select("close", "volume", "revenue", "gross_profit_margin")
    return V.rounded(q.grain("quarterly").execute())


J03 = f"""
SELECT d.symbol, d.date, {_r("close")}, volume, revenue,
       {O.r6("gross_profit / revenue")} AS gross_profit_margin
FROM (SELECT symbol, CAST(date_trunc('quarter', date) AS DATE) AS date,
             last(close ORDER BY date) AS close, CAST(sum(volume) AS BIGINT) AS volume
      FROM daily GROUP BY 1, 2) d
LEFT JOIN quarterly q ON q.symbol = d.symbol AND date_trunc('quarter', q.date) = d.date"""


def j04_snapshot(spark, sf_dir):
    return V.rounded(V.query(spark, sf_dir).select("close", "sector", "beta", "price").execute())


J04 = f"SELECT symbol, date, {_r('close')}, sector, {_r('beta', 'price')} FROM daily LEFT JOIN snapshot USING (symbol)"


def j05_date_only(spark, sf_dir):
    return V.rounded(V.query(spark, sf_dir).select("close", "rate_10y", "yield_curve_slope").execute())


J05 = f"""
SELECT symbol, date, {_r("close", "rate_10y")}, {O.r6("rate_30y - rate_3m")} AS yield_curve_slope
FROM daily LEFT JOIN rates USING (date)"""


def j05_date_only_rolled(spark, sf_dir):
    """Both the prices and the date-only table rolled to months."""
    q = V.query(spark, sf_dir).select("close", "rate_2y").grain("monthly").agg(rate_2y="max")
    return V.rounded(q.execute())


J05_ROLLED = f"""
SELECT symbol, date, {_r("close", "rate_2y")}
FROM (SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS date, last(close ORDER BY date) AS close
      FROM daily GROUP BY 1, 2)
LEFT JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS date, max(rate_2y) AS rate_2y
           FROM rates GROUP BY 1) USING (date)"""

# -- A01–A15 -------------------------------------------------------------------
AGGREGATES = {
    "a01_first": ("first", "first(close ORDER BY date)"),
    "a02_last": ("last", "last(close ORDER BY date)"),
    "a03_sum": ("sum", "sum(CAST(close AS DECIMAL(18,2)))"),
    "a04_mean": ("mean", "avg(close)"),
    "a05_avg": ("avg", "avg(close)"),
    "a06_max": ("max", "max(close)"),
    "a07_min": ("min", "min(close)"),
    "a08_median": ("median", "median(close)"),
    "a09_count": ("count", "count(close)"),
}


def _aggregate(how):
    def run(spark, sf_dir):
        q = V.query(spark, sf_dir).select("close").grain("quarterly").agg(close=how)
        return V.rounded(q.execute())
    return run


def _aggregate_sql(expr):
    value = "count(close)" if "count" in expr else O.r6(f"CAST({expr} AS DOUBLE)")
    return O.sql(f"""
SELECT symbol, CAST(date_trunc('quarter', date) AS DATE) AS date, {value} AS close
FROM daily GROUP BY 1, 2""")


GRAINS = {"a10_weekly": "week", "a11_monthly": "month", "a12_quarterly": "quarter",
          "a13_annual": "year"}
GRAIN_OF = {"week": Grain.WEEKLY, "month": Grain.MONTHLY, "quarter": Grain.QUARTERLY,
            "year": Grain.ANNUAL}
BAR = ["open", "high", "low", "close", "volume", "vwap", "change"]


def _rolled(unit):
    def run(spark, sf_dir):
        return V.rounded(V.query(spark, sf_dir).select(BAR).grain(GRAIN_OF[unit]).execute())
    return run


def _rolled_sql(unit):
    change = O.r6("CAST(sum(CAST(change AS DECIMAL(18,2))) AS DOUBLE)")
    return O.sql(f"""
SELECT symbol, CAST(date_trunc('{unit}', date) AS DATE) AS date,
       {O.r6("first(open ORDER BY date)")} AS open, {O.r6("max(high)")} AS high,
       {O.r6("min(low)")} AS low, {O.r6("last(close ORDER BY date)")} AS close,
       CAST(sum(volume) AS BIGINT) AS volume, {O.r6("avg(vwap)")} AS vwap, {change} AS change
FROM daily GROUP BY 1, 2""")


def a14_date_only(spark, sf_dir):
    q = V.query(spark, sf_dir).select("rate_3m", "rate_10y").grain("monthly").agg(rate_3m="mean")
    return V.rounded(q.execute())


A14 = f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS date, {O.r6("avg(rate_3m)")} AS rate_3m,
       {O.r6("last(rate_10y ORDER BY date)")} AS rate_10y
FROM rates GROUP BY 1"""


def a15_event_sums(spark, sf_dir):
    bought = F.col("acquisition_or_disposition") == "A"
    return V.rounded(V.trades(spark, sf_dir).groupBy("symbol").agg(
        F.sum(F.when(bought, (F.col("securities_transacted") * F.col("insider_price")).cast(
            "decimal(18,4)"))).cast("double").alias("bought_value"),
        F.count_if(bought).alias("buys"),
        F.count_distinct(F.when(bought, F.col("reporting_name"))).alias("buyers"),
    ))


A15 = f"""
SELECT symbol,
       {O.r6("CAST(sum(CAST(securities_transacted * insider_price AS DECIMAL(18,4))) FILTER (acquisition_or_disposition = 'A') AS DOUBLE)")} AS bought_value,
       count(*) FILTER (acquisition_or_disposition = 'A') AS buys,
       count(DISTINCT reporting_name) FILTER (acquisition_or_disposition = 'A') AS buyers
FROM trades GROUP BY 1"""


def o01_ordered(spark, sf_dir):
    return V.rounded(V.query(spark, sf_dir).select("close", "volume").grain("monthly").ordered())


O01 = f"""
SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS date,
       {O.r6("last(close ORDER BY date)")} AS close, CAST(sum(volume) AS BIGINT) AS volume
FROM daily GROUP BY 1, 2 ORDER BY 1, 2"""

QUERIES = {
    "j02_flagship_carry_forward": (j02_flagship, O.sql(J02)),
    "j02_carry_forward_inner": (j02_inner, O.sql(J02_INNER)),
    "j02_carry_forward_event_rows": (j02_event_rows, O.sql(J02_ROWS)),
    "j02_native_grain_features": (j02_native, O.sql(J02_NATIVE)),
    "q01_symbols": (q01_symbols, O.sql(Q01)),
    "q02_q07_select": (q02_select, O.sql(Q02)),
    "q03_date_range": (q03_date_range, O.sql(Q03)),
    "q03_j02_seeded_carry": (q03_seeded_carry, O.sql(Q03_SEEDED)),
    "q03_warm_up": (q03_warm_up, O.sql(Q03_WARM)),
    "q04_q06_agg_override": (q06_agg_override, O.sql(Q06)),
    "q06_calendar_lags": (q06_calendar_lags, O.sql(Q06_CALENDAR)),
    "q05_default_grain": (q05_default_grain, O.sql(Q05)),
    "j01_explicit_spine": (j01_explicit_spine, O.sql(J01)),
    "j03_rolled_and_native": (j03_rolled_and_native, O.sql(J03)),
    "j04_snapshot_join": (j04_snapshot, O.sql(J04)),
    "j05_date_only_join": (j05_date_only, O.sql(J05)),
    "j05_date_only_rolled": (j05_date_only_rolled, O.sql(J05_ROLLED)),
    **{n: (_aggregate(how), _aggregate_sql(expr)) for n, (how, expr) in AGGREGATES.items()},
    **{n: (_rolled(unit), _rolled_sql(unit)) for n, unit in GRAINS.items()},
    "a14_date_only_roll_up": (a14_date_only, O.sql(A14)),
    "a15_event_sums": (a15_event_sums, O.sql(A15)),
    "o01_ordered_result": (o01_ordered, O.sql(O01)),
}
