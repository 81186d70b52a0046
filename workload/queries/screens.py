"""Screens, rankings, indicators, bars, adjusted prices, statement operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain.operators import bars as B
from panelgrain.operators import peers as PE
from panelgrain.operators import screens as SC
from panelgrain.operators import statements as ST
from panelgrain.operators import technical as TE
from panelgrain.operators import medians as MEDIANS
from panelgrain.operators import search as SEARCH
from panelgrain.operators import validity as VALID

from .. import oracle as O
from .. import views as V

W = "PARTITION BY symbol ORDER BY date"
RUN = f"OVER ({W} ROWS UNBOUNDED PRECEDING)"


def _r(*names):
    return ", ".join(f"{O.r6(n)} AS {n}" for n in names)


def _over(n):
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


# -- R01–R05 -------------------------------------------------------------------
def r01_screener(spark, sf_dir):
    out = SC.screen(
        V.snapshot(spark, sf_dir), at_least={"beta": 1.0, "quote_volume": 10},
        at_most={"price": 6000.0}, equal={"country": "US", "is_fund": False},
    )
    return V.rounded(out.select("symbol", "price", "beta", "exchange_short"))


R01 = f"""
SELECT symbol, {_r("price", "beta")}, exchange_short FROM snapshot
WHERE beta >= 1 AND quote_volume >= 10 AND price <= 6000 AND country = 'US' AND NOT is_fund"""


def r01_screener_page(spark, sf_dir):
    """The second page of ten companies by balance."""
    customers = V.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    order = [F.col("c_acctbal").desc(), "c_custkey"]
    return V.rounded(SC.screen(customers, at_least={"c_acctbal": 0.0}, order_by=order, limit=10, page=1))


R01_PAGE = f"""
SELECT c_custkey, c_name, {_r("c_acctbal")} FROM customer WHERE c_acctbal >= 0
ORDER BY customer.c_acctbal DESC, c_custkey LIMIT 10 OFFSET 10"""


def r02_search(spark, sf_dir):
    found = SC.search(V.table(spark, sf_dir, "part"), "Ring", ["p_name", "p_type"])
    return found.select("p_partkey", "p_name", "distance")


R02 = """
SELECT p_partkey, p_name,
       CAST(least(levenshtein(lower(p_name), 'ring'), levenshtein(lower(p_type), 'ring')) AS INTEGER)
           AS distance
FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring')"""


def r03_movers(spark, sf_dir):
    daily = V.daily(spark, sf_dir).select("symbol", "date", "change_pct", "volume")
    lists = {"gainers": ("change_pct", True), "losers": ("change_pct", False),
             "active": ("volume", True)}
    return V.rounded(SC.movers(daily, lists, 3))


R03 = "\nUNION ALL\n".join(
    f"""SELECT symbol, date, {_r("change_pct")}, volume, '{name}' AS list,
       CAST(row_number() OVER (PARTITION BY date ORDER BY daily.{by} {way}, symbol) AS INTEGER) AS rank
FROM daily
QUALIFY row_number() OVER (PARTITION BY date ORDER BY daily.{by} {way}, symbol) <= 3"""
    for name, by, way in (("gainers", "change_pct", "DESC"), ("losers", "change_pct", "ASC"),
                          ("active", "volume", "DESC")))


def r04_sector_performance(spark, sf_dir):
    panel = V.query(spark, sf_dir).select("change_pct", "exchange_short").execute()
    return V.rounded(PE.group_performance(panel, "change_pct", ["date", "exchange_short"]))


R04 = f"""
SELECT date, exchange_short, {O.r6("avg(change_pct)")} AS average_change, count(*) AS symbols
FROM daily JOIN snapshot USING (symbol) GROUP BY 1, 2"""


def r05_sector_pe(spark, sf_dir):
    panel = V.query(spark, sf_dir).select("hist_market_cap", "net_income", "exchange_short").execute()
    return V.rounded(PE.group_pe(panel, "hist_market_cap", "net_income", ["date", "exchange_short"]))


R05 = f"""
SELECT date, exchange_short, {O.r6("sum(hist_market_cap) / nullif(sum(net_income), 0)")} AS pe
FROM (SELECT s.symbol, s.date, hist_market_cap, net_income
      FROM daily s ASOF LEFT JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.date)
JOIN snapshot USING (symbol) GROUP BY 1, 2"""

# -- R06–R14 -------------------------------------------------------------------
INDICATORS = {
    "sma_10": ("sma", 10), "wma_10": ("wma", 10), "deviation_20": ("standard_deviation", 20),
    "williams_14": ("williams", 14),
}
SMOOTHED = {
    "ema_15": ("ema", 15), "dema_15": ("dema", 15), "tema_15": ("tema", 15),
    "rsi_14": ("rsi", 14), "adx_14": ("adx", 14),
}


def _technical(wanted):
    def run(spark, sf_dir):
        daily = V.daily(spark, sf_dir).select("symbol", "date", "high", "low", "close")
        return V.rounded(TE.with_technical(daily, wanted))
    return run


WMA = " + ".join(f"lag(close, {i}) OVER ({W}) * {10 - i}" for i in range(10))
R06 = f"""
SELECT symbol, date, {_r("high", "low", "close")},
       {O.r6(f"CASE WHEN rn >= 10 THEN avg(close) {_over(10)} END")} AS sma_10,
       {O.r6(f"({WMA}) / 55.0::DOUBLE")} AS wma_10,
       {O.r6(f"CASE WHEN rn >= 20 THEN stddev_samp(close) {_over(20)} END")} AS deviation_20,
       {O.r6(f"CASE WHEN rn >= 14 THEN (max(high) {_over(14)} - close) / nullif(max(high) {_over(14)} - min(low) {_over(14)}, 0) * -100 END")} AS williams_14
FROM (SELECT *, row_number() OVER ({W}) AS rn FROM daily)"""


def _ema(value, n):
    g = f"pow({n + 1}.0::DOUBLE / {n - 1}, rn)"
    return f"sum({value} * {g}) {RUN} / sum({g}) {RUN}"


def _wilder(value, n, first):
    """Wilder's mean of a series whose first value is on row ``first``: seed on its n-th value."""
    seed = first + n - 1
    d = f"({n - 1}.0::DOUBLE / {n})"
    step = f"CASE WHEN rn = {seed} THEN seed_{value} WHEN rn > {seed} THEN {value} / {n} END"
    return (f"CASE WHEN rn >= {seed} THEN pow({d}, rn) * sum(({step}) * pow(1 / {d}, rn)) {RUN} END")


def _seeds(*values):
    return ", ".join(f"avg({v}) {_over(14)} AS seed_{v}" for v in values)


R07 = f"""
WITH moves AS (
    SELECT symbol, date, high, low, close, row_number() OVER ({W}) AS rn,
           greatest(close - lag(close) OVER ({W}), 0) + 0 * lag(close) OVER ({W}) AS gain,
           greatest(lag(close) OVER ({W}) - close, 0) + 0 * lag(close) OVER ({W}) AS loss,
           high - lag(high) OVER ({W}) AS up, lag(low) OVER ({W}) - low AS down,
           greatest(high - low, abs(high - lag(close) OVER ({W})), abs(low - lag(close) OVER ({W})))
               + 0 * lag(close) OVER ({W}) AS spread
    FROM daily
), directed AS (
    SELECT *, CASE WHEN up IS NULL THEN NULL WHEN up > down AND up > 0 THEN up ELSE 0 END AS plus,
           CASE WHEN up IS NULL THEN NULL WHEN down > up AND down > 0 THEN down ELSE 0 END AS minus
    FROM moves
), seeded AS (
    SELECT *, {_seeds("gain", "loss", "spread", "plus", "minus")} FROM directed
), once AS (
    SELECT *, {_ema("close", 15)} AS e1,
           {_wilder("gain", 14, 2)} AS avg_gain, {_wilder("loss", 14, 2)} AS avg_loss,
           {_wilder("spread", 14, 2)} AS range14, {_wilder("plus", 14, 2)} AS plus14,
           {_wilder("minus", 14, 2)} AS minus14
    FROM seeded
), twice AS (
    SELECT *, {_ema("e1", 15)} AS e2,
           CASE WHEN rn >= 15 THEN CASE WHEN plus14 + minus14 = 0 THEN 0 ELSE
               100 * abs(plus14 / range14 - minus14 / range14) / (plus14 / range14 + minus14 / range14)
           END END AS dx
    FROM once
), thrice AS (
    SELECT *, {_ema("e2", 15)} AS e3, {_seeds("dx")} FROM twice
)
SELECT symbol, date, {_r("high", "low", "close")}, {O.r6("e1")} AS ema_15,
       {O.r6("2 * e1 - e2")} AS dema_15, {O.r6("3 * e1 - 3 * e2 + e3")} AS tema_15,
       {O.r6("100 * avg_gain / nullif(avg_gain + avg_loss, 0)")} AS rsi_14,
       {O.r6(_wilder("dx", 14, 15))} AS adx_14
FROM thrice"""


# -- R15, R16 ------------------------------------------------------------------
def r15_bars(spark, sf_dir):
    return V.rounded(B.bars(V.events(spark, sf_dir), "6 hours").withColumn(
        "bar_start", F.date_format("bar_start", "yyyy-MM-dd HH:mm")))


R15 = f"""
SELECT symbol, strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01'), '%Y-%m-%d %H:%M')
           AS bar_start,
       {O.r6("first(value ORDER BY ts, event_id)")} AS open, {O.r6("max(value)")} AS high,
       {O.r6("min(value)")} AS low, {O.r6("last(value ORDER BY ts, event_id)")} AS close,
       count(*) AS volume
FROM ev GROUP BY symbol, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01')"""


def r16_adjusted_prices(spark, sf_dir):
    """Quarters whose split terms are 4 for 1 count as splits."""
    splits = V.quarterly(spark, sf_dir).filter(
        (F.col("split_numerator") == 4) & (F.col("split_denominator") == 1)
    )
    factor = F.col("split_denominator") / F.col("split_numerator")
    prices = V.daily(spark, sf_dir).select("symbol", "date", "close")
    # Products of quarters of cents: exact doubles.
    return B.adjust_prices(prices, splits, factor, ["close"])


R16 = """
SELECT d.symbol, d.date, close * pow(0.25, count(s.date)) AS adj_close,
       pow(0.25, count(s.date)) AS adjustment
FROM daily d LEFT JOIN (SELECT symbol, date FROM quarterly
                        WHERE split_numerator = 4 AND split_denominator = 1) s
     ON d.symbol = s.symbol AND s.date > d.date
GROUP BY d.symbol, d.date, close"""

# -- R17–R21 -------------------------------------------------------------------
TTM = ["revenue", "net_income", "ebitda", "free_cash_flow"]


def r17_trailing_twelve_months(spark, sf_dir):
    return ST.trailing_sums(V.quarterly(spark, sf_dir), TTM)


R17 = "SELECT symbol, date, " + ", ".join(
    f"CASE WHEN row_number() OVER ({W}) >= 4 THEN CAST(sum({c}) {_over(4)} AS BIGINT) END AS ttm_{c}"
    for c in TTM) + " FROM quarterly"

GROWN = ["revenue", "gross_profit", "total_assets", "operating_cash_flow"]


def r18_growth_table(spark, sf_dir):
    return V.rounded(ST.growth_table(V.quarterly(spark, sf_dir), GROWN, k=4))


R18 = "SELECT symbol, date, " + ", ".join(
    O.r6(f"({c} - lag({c}, 4) OVER ({W})) / nullif(abs(lag({c}, 4) OVER ({W})), 0)") + f" AS growth_{c}"
    for c in GROWN) + " FROM quarterly"


def r19_insider_statistics(spark, sf_dir):
    return V.rounded(ST.insider_statistics(V.trades(spark, sf_dir)))


R19 = f"""
SELECT symbol, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       count(*) FILTER (acquisition_or_disposition = 'A') AS acquired_trades,
       count(*) FILTER (acquisition_or_disposition = 'D') AS disposed_trades,
       CAST(coalesce(sum(securities_transacted) FILTER (acquisition_or_disposition = 'A'), 0) AS BIGINT)
           AS acquired_shares,
       CAST(coalesce(sum(securities_transacted) FILTER (acquisition_or_disposition = 'D'), 0) AS BIGINT)
           AS disposed_shares,
       {O.r6("count(*) FILTER (acquisition_or_disposition = 'A') / nullif(count(*) FILTER (acquisition_or_disposition = 'D'), 0)")} AS acquired_disposed_ratio
FROM trades GROUP BY 1, 2, 3"""


def r20_member_on_date(spark, sf_dir):
    """Sign-ups add a user, errors remove it; was it a member on the day of each event?"""
    ev = V.events(spark, sf_dir)
    changes = ev.filter(F.col("event_type").isin("signup", "error")).groupBy("symbol", "date").agg(
        F.max_by(F.col("event_type") == "signup", B.tick_order("ts", "event_id")).alias("added")
    )
    return ST.member_on_date(ev.select("symbol", "date", "event_id"), changes)


R20 = """
SELECT e.symbol, e.date, event_id, CAST(coalesce(added, false) AS INTEGER) AS is_member
FROM ev e ASOF LEFT JOIN
     (SELECT symbol, date, last(event_type = 'signup' ORDER BY ts, event_id) AS added
      FROM ev WHERE event_type IN ('signup', 'error') GROUP BY 1, 2) c
     ON e.symbol = c.symbol AND e.date >= c.date"""


def r21_peers(spark, sf_dir):
    panel = V.query(spark, sf_dir).select("change_pct", "exchange_short").execute()
    return V.rounded(PE.peer_statistics(panel, "change_pct", ["date", "exchange_short"]))


def r21_peers_outlier(spark, sf_dir):
    """Some values lie a million times further out than the rest of their group."""
    panel = V.query(spark, sf_dir).select("change_pct", "exchange_short").execute()
    far = F.when(F.expr(FAR), F.col("change_pct") * 1e6).otherwise(F.col("change_pct"))
    return V.rounded(PE.peer_statistics(panel.withColumn("change_pct", far), "change_pct", ["date", "exchange_short"]))


FAR = "symbol LIKE '%7'"
P = "PARTITION BY date, exchange_short"
R21 = f"""
SELECT symbol, date, exchange_short, {_r("change_pct")},
       {O.r6(f"median(change_pct) OVER ({P})")} AS peer_median,
       {O.r6(f"change_pct - median(change_pct) OVER ({P})")} AS to_peer_median,
       {O.r6(f"(change_pct - avg(change_pct) OVER ({P})) / nullif(stddev_samp(change_pct) OVER ({P}), 0)")} AS peer_z,
       {O.r6(f"CASE WHEN count(*) OVER ({P}) > 1 THEN percent_rank() OVER ({P} ORDER BY d.change_pct) END")}
           AS peer_percentile
FROM daily d JOIN snapshot USING (symbol)"""
R21_OUTLIER = R21.replace(
    "FROM daily d", f"FROM (SELECT * REPLACE (CASE WHEN {FAR} THEN change_pct * 1e6 ELSE change_pct END AS change_pct) FROM daily) d")

def r02_fuzzy(spark, sf_dir):
    """Customer names and part types searched by misspelt ones: a letter lost, one doubled, two changed."""
    names = V.table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), F.col("p_partkey").alias("part"))
    key = F.col("part") % 50 == 0
    wrong = F.concat(F.substring("name", 1, 3), F.lit("x"), F.expr("substring(name, 5)"))
    queries = names.filter(key).select(wrong.alias("query"))
    return SEARCH.fuzzy_search(names, "name", queries, 2).select("part", "name", "query", "distance")


R02_FUZZY = """
WITH n AS (SELECT lower(p_name) AS name, p_partkey AS part FROM part),
q AS (SELECT DISTINCT substr(name, 1, 3) || 'x' || substr(name, 5) AS query FROM n WHERE part % 50 = 0)
SELECT part, name, query, CAST(levenshtein(query, name) AS INTEGER) AS distance
FROM n JOIN q ON levenshtein(query, name) <= 2"""


def r20_intervals(spark, sf_dir):
    """Events with the state that the last sign-up or error of their user set, on its day or before."""
    events = V.events(spark, sf_dir)
    changes = events.filter(F.col("event_type").isin("signup", "error")).select(
        "symbol", "date", "ts", "event_id", (F.col("event_type") == "signup").alias("active"))
    spans = VALID.validity(changes, "active", ["ts", "event_id"])
    return VALID.join_valid(events.select("symbol", "date", "event_id"), spans, "active")


R20_INTERVALS = """
WITH c AS (SELECT symbol, date, last(event_type ORDER BY ts, event_id) = 'signup' AS active
           FROM ev WHERE event_type IN ('signup', 'error') GROUP BY 1, 2)
SELECT e.symbol, e.date, event_id, active FROM ev e ASOF LEFT JOIN c ON e.symbol = c.symbol AND e.date >= c.date"""


def a08_raw_median(spark, sf_dir):
    """Median price of single order lines by return flag: three groups that hold all rows."""
    lines = V.lines(spark, sf_dir).select(F.col("l_returnflag").alias("symbol"), "px")
    return V.rounded(MEDIANS.medians(lines, "px"))


A08_RAW = f"""SELECT l_returnflag AS symbol, {O.r6("median(px)")} AS median FROM lines GROUP BY 1"""

QUERIES = {
    "r02_fuzzy_search": (r02_fuzzy, O.sql(R02_FUZZY)),
    "r20_validity_intervals": (r20_intervals, O.sql(R20_INTERVALS)),
    "a08_median_of_raw_rows": (a08_raw_median, O.sql(A08_RAW)),
    "r01_screener": (r01_screener, O.sql(R01)),
    "r01_screener_page": (r01_screener_page, O.sql(R01_PAGE)),
    "r02_symbol_search": (r02_search, O.sql(R02)),
    "r03_movers": (r03_movers, O.sql(R03)),
    "r04_sector_performance": (r04_sector_performance, O.sql(R04)),
    "r05_sector_pe": (r05_sector_pe, O.sql(R05)),
    "r06_r08_r12_r13_windowed_indicators": (_technical(INDICATORS), O.sql(R06)),
    "r07_r09_r10_r11_r14_smoothed_indicators": (_technical(SMOOTHED), O.sql(R07)),
    "r15_intraday_bars": (r15_bars, O.sql(R15)),
    "r16_adjusted_prices": (r16_adjusted_prices, O.sql(R16)),
    "r17_trailing_twelve_months": (r17_trailing_twelve_months, O.sql(R17)),
    "r18_growth_table": (r18_growth_table, O.sql(R18)),
    "r19_insider_statistics": (r19_insider_statistics, O.sql(R19)),
    "r20_member_on_date": (r20_member_on_date, O.sql(R20)),
    "r21_peer_statistics": (r21_peers, O.sql(R21)),
    "r21_peer_statistics_outlier": (r21_peers_outlier, O.sql(R21_OUTLIER)),
}
