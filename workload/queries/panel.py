"""Recursive, market-relative, membership and signal features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelgrain import FrameSource, PanelQuery
from panelgrain.functions.registry import FeatureRegistry
from panelgrain.operators import panel_features as PF
from panelgrain.operators import signals as S

from .. import oracle as O
from .. import views as V

W = "PARTITION BY symbol ORDER BY date"


def _r(*names):
    return ", ".join(f"{O.r6(n)} AS {n}" for n in names)


def _ema(value, span, row="rn"):
    """Adjusted exponential mean as a quotient of running sums with growing weights.

    Fine for the few thousand rows of the check; a longer series would overflow.
    """
    growth = f"pow({span + 1}.0::DOUBLE / {span - 1}, {row})"
    run = f"OVER ({W} ROWS UNBOUNDED PRECEDING)"
    return f"sum({value} * {growth}) {run} / sum({growth}) {run}"


def p01_p08_smoothing(spark, sf_dir):
    return V.rounded(V.query(spark, sf_dir).select("close", list(PF.SMOOTHED)).execute())


P01 = f"""
WITH numbered AS (
    SELECT symbol, date, close, row_number() OVER ({W}) AS rn FROM daily
), means AS (
    SELECT *, {", ".join(f"{_ema('close', n)} AS ema_{n}" for n in PF.SPANS)} FROM numbered
), crossed AS (
    SELECT *, ema_12 - ema_26 AS macd_line FROM means
), signalled AS (
    SELECT *, {_ema("macd_line", 9)} AS macd_signal FROM crossed
)
SELECT symbol, date, {_r("close", *[f"ema_{n}" for n in PF.SPANS], "macd_line", "macd_signal")},
       {O.r6("macd_line - macd_signal")} AS macd_histogram
FROM signalled"""


def p09_autocorrelation(spark, sf_dir):
    return V.rounded(V.query(spark, sf_dir).select("return_autocorrelation_21d").execute())


P09 = f"""
SELECT symbol, date, {O.r6("CASE WHEN n >= 10 THEN c END")} AS return_autocorrelation_21d
FROM (SELECT symbol, date,
             corr(ret, before) OVER f AS c,
             count(CASE WHEN ret IS NOT NULL AND before IS NOT NULL THEN 1 END) OVER f AS n
      FROM (SELECT *, lag(ret) OVER ({W}) AS before
            FROM (SELECT *, close / lag(close) OVER ({W}) - 1 AS ret FROM daily))
      WINDOW f AS ({W} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))"""


def p10_dividend_streak(spark, sf_dir):
    q = V.query(spark, sf_dir).select("adj_dividend", "consecutive_dividend_increases")
    return V.rounded(q.execute())


P10 = f"""
SELECT symbol, date, {_r("adj_dividend")},
       count(*) FILTER (rises) OVER (PARTITION BY symbol, island ORDER BY date)
           AS consecutive_dividend_increases
FROM (SELECT *, sum(CASE WHEN rises THEN 0 ELSE 1 END) OVER ({W}) AS island
      FROM (SELECT *, coalesce(adj_dividend > lag(adj_dividend) OVER ({W}), false) AS rises
            FROM quarterly))"""


def p11_p12_beta_alpha(spark, sf_dir):
    q = V.query(spark, sf_dir).select("beta_sp500", "alpha_jensen")
    return V.rounded(q.using(benchmark=V.index_px(spark, sf_dir)).execute())


P11 = f"""
WITH market AS (
    SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS m,
           close / lag(close, 252) OVER (ORDER BY date) - 1 AS m_long
    FROM index_px
), joined AS (
    SELECT symbol, date, r, r_long, m, m_long
    FROM (SELECT symbol, date, close / lag(close) OVER ({W}) - 1 AS r,
                 close / lag(close, 252) OVER ({W}) - 1 AS r_long
          FROM daily) LEFT JOIN market USING (date)
), measured AS (
    SELECT *, CASE WHEN least(count(CASE WHEN r IS NOT NULL AND m IS NOT NULL THEN 1 END) OVER f,
                              count(r) OVER f, count(m) OVER f) >= 60
                   THEN corr(r, m) OVER f * stddev_samp(r) OVER f / nullif(stddev_samp(m) OVER f, 0)
              END AS beta
    FROM joined WINDOW f AS ({W} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)
)
SELECT symbol, date, {O.r6("beta")} AS beta_sp500, {O.r6("r_long - beta * m_long")} AS alpha_jensen
FROM measured"""


def p13_p15_membership(spark, sf_dir):
    """Three member lists: heavily traded brands, ETFs and British listings stand in."""
    snap = V.snapshot(spark, sf_dir)
    q = V.query(spark, sf_dir).select("volume", "in_sp500", "in_nasdaq", "in_dowjones")
    return q.using(
        sp500_constituents=V.members(spark, sf_dir),
        nasdaq_constituents=snap.filter("exchange_short = 'NASDAQ'"),
        dowjones_constituents=snap.filter("country = 'GB'"),
    ).execute()


P13 = """
SELECT symbol, date, volume,
       CASE WHEN symbol IN (SELECT symbol FROM members) THEN 1 ELSE 0 END AS in_sp500,
       CASE WHEN exchange_short = 'NASDAQ' THEN 1 ELSE 0 END AS in_nasdaq,
       CASE WHEN country = 'GB' THEN 1 ELSE 0 END AS in_dowjones
FROM daily JOIN snapshot USING (symbol)"""


def _signals(table, build, names, days):
    def run(spark, sf_dir):
        as_of = F.lit(V.EVENTS_AS_OF).cast("date")
        spine = V.event_days(spark, sf_dir)
        events = getattr(V, table)(spark, sf_dir)
        return V.rounded(S.with_signals(spine, events, S.pick(build(*days), names), as_of))
    return run


def _trailing(table, build, names, days):
    """The same signals counted back from each row's own date."""
    def run(spark, sf_dir):
        spine, events = V.event_days(spark, sf_dir), getattr(V, table)(spark, sf_dir)
        return V.rounded(S.with_trailing_signals(spine, events, S.pick(build(*days), names)))
    return run


MID = "2024-01-15"


def p16_p23_from_tables(spark, sf_dir):
    """The builder reads the trades itself: three loads, of which the second corrects half of the
    symbols and the third is newer than the version asked for; the as-of day lies among the trades."""
    loads = F.array(*[F.struct(F.lit(f"2024-02-0{k}").cast("timestamp").alias("at"), F.lit(by).alias("by"))
                      for k, by in ((1, 0.0), (2, 1.0), (3, 100.0))])
    loaded = V.insider_events(spark, sf_dir).withColumn("load", F.explode(loads)).filter(
        "load.by <> 1.0 OR CAST(symbol AS BIGINT) % 2 = 0")
    trades = loaded.withColumns({
        "insider_price": F.col("insider_price") + F.col("load.by"), "_fetched_at": F.col("load.at")}).drop("load")
    source = FrameSource({"daily_price": V.event_days(spark, sf_dir), "insider_trades": trades})
    q = PanelQuery(source, V.registry()).all_symbols().select("close", *PF.INSIDER)
    return V.rounded(q.as_of(MID).version_as_of("2024-02-02 12:00:00").execute())


def _loaded(events, column, swap):
    """Three loads: all events, those of even symbols with two kinds exchanged, and one newer than is asked for."""
    loads = F.explode(F.array(*[F.struct(F.lit(f"2024-02-0{k}").cast("timestamp").alias("at"), F.lit(k).alias("no"))
                                for k in (1, 2, 3)]))
    a, b = swap
    kind = F.col(column)
    other = F.when(kind == a, b).when(kind == b, a).otherwise(kind)
    return (events.withColumn("load", loads).filter("load.no <> 2 OR CAST(symbol AS BIGINT) % 2 = 0")
            .select("symbol", "date", F.when(F.col("load.no") == 1, kind).when(F.col("load.no") == 2, other).alias(column),
                    F.col("load.at").alias("_fetched_at")))


def _from_table(table, events, column, kind, swap, names):
    """The builder reads the event table itself, as of a version and a day."""
    def run(spark, sf_dir):
        rows = _loaded(getattr(V, events)(spark, sf_dir), column, swap).withColumnRenamed(column, kind)
        source = FrameSource({"daily_price": V.event_days(spark, sf_dir), table: rows})
        q = PanelQuery(source, V.registry()).all_symbols().select("close", *names)
        return V.rounded(q.as_of(MID).version_as_of("2024-02-02 12:00:00").execute())
    return run


def _swapped(a, b):
    """SQL text: the kind of an event after the second load."""
    return (f"(CASE WHEN CAST(symbol AS BIGINT) % 2 = 1 THEN event_type WHEN event_type = '{a}' THEN '{b}' "
            f"WHEN event_type = '{b}' THEN '{a}' ELSE event_type END)")


def _back(n):
    return f"e.date >= s.date - {n}"


def _trailing_insider_sql(long, short):
    a, d = "acquisition_or_disposition = 'A'", "acquisition_or_disposition = 'D'"
    value = "securities_transacted * insider_price"
    return O.sql(f"""
SELECT symbol, date, {_r("close")}, {O.r6("bought - sold")} AS insider_net_buying_90d,
       buys_short AS insider_buy_count_30d, sells_short AS insider_sell_count_30d,
       {O.r6("buys / nullif(sells, 0)")} AS insider_buy_sell_ratio_90d,
       CAST(traders >= 3 AS INTEGER) AS insider_buying_cluster,
       {O.r6("bought")} AS insider_total_bought_90d, {O.r6("sold")} AS insider_total_sold_90d,
       CAST(senior > 0 AS INTEGER) AS insider_officer_buying
FROM (SELECT s.symbol, s.date, s.close,
             coalesce(sum({value}) FILTER ({a} AND {_back(long)}), 0) AS bought,
             coalesce(sum({value}) FILTER ({d} AND {_back(long)}), 0) AS sold,
             count(*) FILTER ({a} AND {_back(long)}) AS buys,
             count(*) FILTER ({d} AND {_back(long)}) AS sells,
             count(*) FILTER ({a} AND {_back(short)}) AS buys_short,
             count(*) FILTER ({d} AND {_back(short)}) AS sells_short,
             count(DISTINCT reporting_name) FILTER ({a} AND {_back(short)}) AS traders,
             count(*) FILTER ({a} AND {_back(long)} AND event_id % 3 = 0) AS senior
      FROM event_days s LEFT JOIN trades e ON e.symbol = s.symbol AND e.date <= s.date
      GROUP BY 1, 2, 3)""")


def _trailing_senate_sql(long, short):
    return O.sql(f"""
SELECT s.symbol, s.date, {O.r6("s.close")} AS close,
       count(*) FILTER (event_type = 'purchase' AND {_back(long)}) AS senate_buy_count_90d,
       count(*) FILTER (event_type = 'click' AND {_back(long)}) AS senate_sell_count_90d,
       count(*) FILTER (event_type = 'purchase' AND {_back(long)})
           - count(*) FILTER (event_type = 'click' AND {_back(long)}) AS senate_net_flow_90d,
       CAST(count(*) FILTER ({_back(short)}) > 0 AS INTEGER) AS senate_activity_flag
FROM event_days s LEFT JOIN ev e ON e.symbol = s.symbol AND e.date <= s.date
GROUP BY s.symbol, s.date, s.close""")


def _insider_sql(long, short, as_of=V.EVENTS_AS_OF, price="insider_price"):
    def since(n):
        return f"date BETWEEN DATE '{as_of}' - {n} AND DATE '{as_of}'"
    a, d = "acquisition_or_disposition = 'A'", "acquisition_or_disposition = 'D'"
    value = f"securities_transacted * {price}"
    return O.sql(f"""
WITH per_symbol AS (
    SELECT symbol,
           coalesce(sum({value}) FILTER ({a} AND {since(long)}), 0) AS bought,
           coalesce(sum({value}) FILTER ({d} AND {since(long)}), 0) AS sold,
           count(*) FILTER ({a} AND {since(long)}) AS buys,
           count(*) FILTER ({d} AND {since(long)}) AS sells,
           count(*) FILTER ({a} AND {since(short)}) AS buys_short,
           count(*) FILTER ({d} AND {since(short)}) AS sells_short,
           count(DISTINCT reporting_name) FILTER ({a} AND {since(short)}) AS traders,
           count(*) FILTER ({a} AND {since(long)} AND event_id % 3 = 0) AS senior
    FROM trades GROUP BY 1
)
SELECT symbol, date, {_r("close")},
       {O.r6("bought - sold")} AS insider_net_buying_90d,
       buys_short AS insider_buy_count_30d, sells_short AS insider_sell_count_30d,
       {O.r6("buys / nullif(sells, 0)")} AS insider_buy_sell_ratio_90d,
       CAST(traders >= 3 AS INTEGER) AS insider_buying_cluster,
       {O.r6("bought")} AS insider_total_bought_90d, {O.r6("sold")} AS insider_total_sold_90d,
       CAST(senior > 0 AS INTEGER) AS insider_officer_buying
FROM event_days LEFT JOIN per_symbol USING (symbol)""")


def _senate_sql(long, short, as_of=V.EVENTS_AS_OF, kinds="event_type"):
    def since(n):
        return f"date BETWEEN DATE '{as_of}' - {n} AND DATE '{as_of}'"
    return O.sql(f"""
SELECT symbol, date, {_r("close")}, p AS senate_buy_count_90d, s AS senate_sell_count_90d,
       p - s AS senate_net_flow_90d, CAST(n > 0 AS INTEGER) AS senate_activity_flag
FROM event_days LEFT JOIN
     (SELECT symbol, count(*) FILTER ({kinds} = 'purchase' AND {since(long)}) AS p,
             count(*) FILTER ({kinds} = 'click' AND {since(long)}) AS s,
             count(*) FILTER ({since(short)}) AS n
      FROM ev GROUP BY 1) USING (symbol)""")


def _grades_sql(long, as_of=V.EVENTS_AS_OF, kinds="event_type"):
    return O.sql(f"""
SELECT symbol, date, {_r("close")}, u AS upgrades_90d, d AS downgrades_90d,
       {O.r6("u / nullif(d, 0)")} AS upgrade_downgrade_ratio
FROM event_days LEFT JOIN
     (SELECT symbol, count(*) FILTER ({kinds} = 'signup') AS u,
             count(*) FILTER ({kinds} = 'error') AS d
      FROM ev WHERE date BETWEEN DATE '{as_of}' - {long} AND DATE '{as_of}' GROUP BY 1) USING (symbol)""")


def u01_u02_registered_features(spark, sf_dir):
    """A user's own scalar feature, one built on a built-in one, and a panel feature."""
    registry = FeatureRegistry()
    built_in = V.registry().features["return_5d"].build

    @registry.feature("range_share", "mine")
    def range_share(p):
        return F.try_divide(p["high"] - p["low"], p["close"])

    @registry.feature("week_gain", "mine")
    def week_gain(p):
        return F.greatest(built_in(p), F.lit(0.0))

    @registry.panel("ranks", "mine", ["volume"], ["volume_rank"])
    def ranks(df, names, inputs):
        w = Window.partitionBy("symbol").orderBy(F.col("volume").desc(), "date")
        return df.withColumn(names[0], F.row_number().over(w))

    q = V.PanelQuery(V.source(spark, sf_dir), registry).all_symbols()
    return V.rounded(q.select("range_share", "week_gain", "volume_rank").execute())


U01 = f"""
SELECT symbol, date, {O.r6("(high - low) / nullif(close, 0)")} AS range_share,
       {O.r6(f"greatest(close / lag(close, 5) OVER ({W}) - 1, 0)")} AS week_gain,
       CAST(row_number() OVER (PARTITION BY symbol ORDER BY volume DESC, date) AS INTEGER) AS volume_rank
FROM daily"""


def u03_reference_symbol(spark, sf_dir):
    """One symbol of the price table is the market of all others."""
    q = V.query(spark, sf_dir).select("close", "beta_sp500").benchmark("Brand#1")
    return V.rounded(q.execute())


U03 = f"""
WITH market AS (
    SELECT date, close / lag(close) OVER (ORDER BY date) - 1 AS m FROM daily WHERE symbol = 'Brand#1'
), joined AS (
    SELECT symbol, date, close, r, m
    FROM (SELECT *, close / lag(close) OVER ({W}) - 1 AS r FROM daily) LEFT JOIN market USING (date)
)
SELECT symbol, date, {_r("close")}, {O.r6("beta")} AS beta_sp500
FROM (SELECT *, CASE WHEN least(count(CASE WHEN r IS NOT NULL AND m IS NOT NULL THEN 1 END) OVER f,
                                count(r) OVER f, count(m) OVER f) >= 60
                     THEN corr(r, m) OVER f * stddev_samp(r) OVER f / nullif(stddev_samp(m) OVER f, 0)
                END AS beta
      FROM joined WINDOW f AS ({W} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))"""


def q08_dependency_closure(spark, sf_dir):
    """The stored fields behind two features come along."""
    q = V.query(spark, sf_dir).select("net_debt_to_ebitda", "gmi").with_inputs()
    return V.rounded(q.execute())


Q08 = f"""
SELECT symbol, date, {O.r6("(total_debt - cash_and_equivalents) / nullif(ebitda, 0)")}
           AS net_debt_to_ebitda,
       {O.r6(f"lag(gross_profit / revenue) OVER ({W}) / nullif(gross_profit / revenue, 0)")} AS gmi,
       total_debt, cash_and_equivalents, ebitda, gross_profit, revenue
FROM quarterly"""

QUERIES = {
    "q08_dependency_closure": (q08_dependency_closure, O.sql(Q08)),
    "u01_u02_registered_features": (u01_u02_registered_features, O.sql(U01)),
    "u03_reference_symbol": (u03_reference_symbol, O.sql(U03)),
    "p01_p08_w12_smoothing": (p01_p08_smoothing, O.sql(P01)),
    "p09_autocorrelation": (p09_autocorrelation, O.sql(P09)),
    "p10_w13_dividend_streak": (p10_dividend_streak, O.sql(P10)),
    "p11_p12_j06_beta_alpha": (p11_p12_beta_alpha, O.sql(P11)),
    "p13_p15_j08_membership": (p13_p15_membership, O.sql(P13)),
    "p16_p23_j07_insider_signals": (
        _signals("insider_events", S.insider_signals, PF.INSIDER, (90, 30)), _insider_sql(90, 30)),
    "p16_p23_insider_signals_from_tables": (
        p16_p23_from_tables,
        _insider_sql(90, 30, MID, "(insider_price + CASE WHEN CAST(symbol AS BIGINT) % 2 = 0 THEN 1 ELSE 0 END)")),
    "p16_p23_insider_signals_14_7": (
        _signals("insider_events", S.insider_signals, PF.INSIDER, (14, 7)), _insider_sql(14, 7)),
    "p24_p27_senate_signals": (
        _signals("senate_events", S.senate_signals, PF.SENATE, (90, 30)), _senate_sql(90, 30)),
    "p24_p27_senate_signals_14_7": (
        _signals("senate_events", S.senate_signals, PF.SENATE, (14, 7)), _senate_sql(14, 7)),
    "p16_p23_insider_signals_trailing": (
        _trailing("insider_events", S.insider_signals, PF.INSIDER, (9, 4)), _trailing_insider_sql(9, 4)),
    "p24_p27_senate_signals_trailing": (
        _trailing("senate_events", S.senate_signals, PF.SENATE, (9, 4)), _trailing_senate_sql(9, 4)),
    "p24_p27_senate_from_tables": (
        _from_table("senate_trades", "senate_events", "type", "senate_trade_type", ("Purchase", "Sale (Full)"), PF.SENATE),
        _senate_sql(90, 30, MID, _swapped("purchase", "click"))),
    "p28_p30_grades_from_tables": (
        _from_table("grade_changes", "grade_events", "action", "grade_action", ("Upgrade", "downgrade"), PF.GRADES),
        _grades_sql(90, MID, _swapped("signup", "error"))),
    "p28_p30_grade_signals": (
        _signals("grade_events", S.grade_signals, PF.GRADES, (90,)), _grades_sql(90)),
    "p28_p30_grade_signals_14": (
        _signals("grade_events", S.grade_signals, PF.GRADES, (14,)), _grades_sql(14)),
}
