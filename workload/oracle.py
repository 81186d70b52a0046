"""The derived views of ``views.py`` as DuckDB SQL, and a helper that assembles statements."""

from __future__ import annotations

import re
from pathlib import Path

SQL_DIR = Path(__file__).parent / "sql"

_SPANS = ("1d", "5d", "1m", "3m", "6m", "ytd", "1y", "3y", "5y")


def r6(expr: str) -> str:
    """Six decimals by the same double arithmetic as the Spark side."""
    return f"floor(({expr}) * 1e6 + 0.51) / 1e6"


def _share(share: str, amount: str) -> str:
    return f"CAST(round(CAST({share} AS DECIMAL(6,2)) * {amount}, 0) AS BIGINT)"


def _grade_counts(prefix: str = "") -> str:
    tests = {"strong_buy": "l_returnflag = 'A'", "buy": "l_returnflag = 'N'",
             "hold": "l_returnflag = 'R'", "sell": "l_linestatus = 'F'",
             "strong_sell": "l_linestatus = 'O'"}
    return ", ".join(f"CAST(count(*) FILTER ({t}) AS INTEGER) AS {prefix}{n}" for n, t in tests.items())


VIEWS = {
    "lines": """
        SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
               floor(l_extendedprice / l_quantity * 100 + 0.5) / 100.0 AS px,
               CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS net,
               CAST(l_extendedprice * (1 - l_discount) * l_tax AS DECIMAL(18,6)) AS taxed,
               lineitem.*, p_type, p_size, p_retailprice
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "daily": """
        SELECT *, close AS adj_close, turnover / volume AS vwap, close - open AS change,
               (close - open) / open * 100 AS change_pct,
               CAST(floor(close * 1000000 + 0.5) AS BIGINT) AS hist_market_cap
        FROM (SELECT symbol, date,
                     first(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS open,
                     max(px) AS high, min(px) AS low,
                     last(px ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS close,
                     CAST(sum(l_quantity) AS BIGINT) AS volume,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS turnover
              FROM lines GROUP BY 1, 2)""",
    "rates": """
        SELECT date, t AS rate_3m, d AS rate_2y, t + d AS rate_10y, t + d + 1 AS rate_30y
        FROM (SELECT CAST(l_shipdate AS DATE) AS date,
                     100 * CAST(sum(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS t,
                     100 * CAST(sum(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS d
              FROM lineitem GROUP BY 1)""",
    "sums": """
        SELECT symbol,
               CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS date,
               sum(net) AS r,
               sum(CAST(p_retailprice * l_quantity AS DECIMAL(18,4))) AS p,
               sum(taxed) AS t,
               sum(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS d,
               CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n
        FROM lines GROUP BY 1, 2""",
    "quarterly": f"""
        SELECT *, operating_cash_flow + capex AS free_cash_flow
        FROM (SELECT *, net_income / weighted_avg_shares_diluted AS eps_diluted,
                     net_income / weighted_avg_shares_diluted AS earnings_eps,
                     CAST(operating_income AS DOUBLE) * 0.8::DOUBLE / weighted_avg_shares_diluted AS eps_estimated,
                     CAST(income_before_tax AS DOUBLE) * 1.1::DOUBLE / weighted_avg_shares_diluted AS est_eps_avg,
                     net_income + depreciation_and_amortization AS operating_cash_flow
        FROM (SELECT *, income_before_tax - income_tax_expense AS net_income
        FROM (SELECT *, operating_income - interest_expense AS income_before_tax,
                     operating_income + depreciation_and_amortization AS ebitda
        FROM (SELECT *, gross_profit - operating_expenses AS operating_income
        FROM (SELECT *, revenue - cost_of_revenue AS gross_profit,
                     sga_expenses + rd_expenses AS operating_expenses,
                     total_assets - total_liabilities AS total_stockholders_equity,
                     market_cap + total_debt - cash_and_equivalents AS enterprise_value,
                     revenue AS earnings_revenue,
                     -dividends_paid / weighted_avg_shares_diluted AS adj_dividend
        FROM (SELECT symbol, date, 'Q' || quarter(date) AS period,
            {_share("1", "r")} AS revenue,
            {_share("0.5", "p")} AS cost_of_revenue,
            {_share("0.1", "r")} AS sga_expenses,
            {_share("0.05", "p")} AS rd_expenses,
            {_share("0.2", "d")} AS interest_expense,
            {_share("0.05", "d")} AS interest_income,
            {_share("1", "t")} AS income_tax_expense,
            {_share("0.03", "p")} AS depreciation_and_amortization,
            1000 * q AS weighted_avg_shares_diluted,
            990 * q AS weighted_avg_shares,
            {_share("0.1", "r")} AS cash_and_equivalents,
            {_share("0.05", "r")} AS short_term_investments,
            {_share("0.15", "r")} AS net_receivables,
            {_share("0.2", "p")} AS inventory,
            {_share("0.03", "p")} AS other_current_assets,
            CAST(round(CAST(0.5 AS DECIMAL(6,2)) * r + CAST(0.2 AS DECIMAL(6,2)) * p, 0) AS BIGINT)
                AS total_current_assets,
            {_share("0.8", "p")} AS property_plant_equipment,
            {_share("0.05", "p")} AS goodwill,
            {_share("0.08", "p")} AS goodwill_and_intangibles,
            CAST(round(CAST(2 AS DECIMAL(6,2)) * r + p, 0) AS BIGINT) AS total_assets,
            {_share("0.12", "p")} AS accounts_payable,
            {_share("0.3", "p")} AS total_current_liabilities,
            {_share("0.3", "r")} AS long_term_debt,
            {_share("0.4", "r")} AS total_debt,
            CAST(round(CAST(0.4 AS DECIMAL(6,2)) * r + CAST(0.5 AS DECIMAL(6,2)) * p, 0) AS BIGINT)
                AS total_liabilities,
            {_share("0.3", "r")} AS retained_earnings,
            {_share("0.02", "r")} AS deferred_revenue,
            {_share("-0.04", "p")} AS capex,
            {_share("-0.1", "r")} AS dividends_paid,
            {_share("-0.1", "d")} AS share_repurchase,
            {_share("0.1", "d")} AS debt_repayment,
            {_share("12", "r")} AS market_cap,
            {_share("0.9", "p")} AS revenue_estimated,
            {_share("1.05", "r")} AS est_revenue_avg,
            CAST(n % 20 AS INTEGER) AS num_analysts_eps,
            CAST(2 + q % 3 AS INTEGER) AS split_numerator,
            CAST(1 + q % 2 AS INTEGER) AS split_denominator,
            CAST(n AS INTEGER) AS hist_inst_holders,
            CAST(n % 7 - 3 AS INTEGER) AS hist_inst_holders_change,
            {_share("1", "p")} AS hist_inst_invested,
            {_share("0.1", "d")} AS hist_inst_invested_change
        FROM sums))))))""",
    "monthly": f"""
        SELECT symbol, last_day(date) AS date, {_grade_counts("hist_")} FROM lines GROUP BY 1, 2""",
    "annual": """
        SELECT symbol, make_date(year(date), 12, 31) AS date,
               CAST(count(*) AS INTEGER) AS employee_count_val
        FROM lines GROUP BY 1, 2""",
    "brands": f"""
        SELECT symbol, CAST(regexp_extract(symbol, '(\\d+)$', 1) AS INTEGER) AS b,
               last(px ORDER BY date, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS price,
               max(px) AS year_high, min(px) AS year_low,
               CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n, sum(net) AS r,
               min(date) AS ipo_date,
               CAST(sum(p_size) AS BIGINT) AS sizes,
               CAST(max(p_size) AS DOUBLE) AS esg_social,
               CAST(min(p_size) AS DOUBLE) AS esg_governance,
               {_grade_counts()}
        FROM lines GROUP BY 1""",
    "snapshot": f"""
        SELECT symbol, price, year_high, year_low, ipo_date,
               (SELECT min(p_type) FROM part WHERE p_brand = symbol) AS sector,
               (SELECT max(p_type) FROM part WHERE p_brand = symbol) AS industry,
               CAST(round(r, 0) AS BIGINT) AS quote_market_cap,
               CAST(round(r, 0) AS BIGINT) AS profile_market_cap,
               q // n AS quote_volume,
               ['NYSE', 'NASDAQ', 'LSE', 'AMEX'][b % 4 + 1] AS exchange_short,
               CASE WHEN b % 4 = 2 THEN 'GB' ELSE 'US' END AS country,
               b % 7 = 0 AS is_etf, b % 11 = 0 AS is_fund, b % 5 <> 0 AS is_actively_trading,
               (b % 30 + 5) / 10.0::DOUBLE AS beta,
               year_high * 1.1::DOUBLE AS target_high, year_low * 0.9::DOUBLE AS target_low,
               price * 1.2::DOUBLE AS target_consensus, price * 1.1::DOUBLE AS target_median,
               strong_buy, buy, hold, sell, strong_sell,
               b % 5 + 1 AS provider_rating_score,
               800 * q AS float_shares, 1000 * q AS outstanding_shares,
               price * 1.05::DOUBLE AS dcf_val,
               sizes / n AS esg_environmental, esg_social, esg_governance,
               sizes / n + esg_social AS esg_score,
               {", ".join(f"price / year_low - {i + 1} / 10.0::DOUBLE AS provider_return_{s}"
                          for i, s in enumerate(_SPANS))},
               CAST(n AS INTEGER) AS inst_holders_count,
               CAST(n - 3 AS INTEGER) AS inst_holders_prev, 3 AS inst_holders_change,
               CAST(round(r, 0) AS BIGINT) AS inst_total_invested,
               CAST(round(r, 0) AS BIGINT) - 1000 * n AS inst_invested_prev,
               1000 * n AS inst_invested_change, q / n AS inst_put_call_ratio
        FROM brands""",
    "members": """
        SELECT symbol FROM (SELECT symbol, count(*) AS n FROM lines GROUP BY 1)
        WHERE n > (SELECT avg(n) FROM (SELECT count(*) AS n FROM lines GROUP BY symbol))""",
    "index_px": """
        SELECT date, floor(CAST(sum(CAST(close AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 + 0.5)
                     / 100.0 AS close
        FROM daily GROUP BY 1""",
    "ev": """
        SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, events.* FROM events""",
    "event_versions": """
        SELECT symbol, date, value, ts AS fetched_at, event_id AS seq FROM ev""",
    "trades": """
        SELECT symbol, date, event_id, ts,
               CASE event_type WHEN 'purchase' THEN 'A' WHEN 'click' THEN 'D' ELSE '-' END
                   AS acquisition_or_disposition,
               CAST(json_extract(props, '$.k') AS BIGINT) AS securities_transacted,
               value AS insider_price, CAST(event_id % 7 AS VARCHAR) AS reporting_name,
               CASE WHEN event_id % 3 = 0 THEN 'Officer: vice president' ELSE 'director holder' END
                   AS type_of_owner
        FROM ev""",
    "insider_trades": """
        SELECT * FROM trades
        QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC, event_id DESC) = 1""",
    "event_days": """
        SELECT symbol, date, last(value ORDER BY ts, event_id) AS close FROM ev GROUP BY 1, 2""",
}


def _needs(text: str) -> set[str]:
    words = set(re.findall(r"\b[a-z_]+\b", text))
    return {v for v in VIEWS if v in words}


def sql(body: str) -> str:
    """Prefix a statement with the views it mentions, in dependency order."""
    body = body.strip()
    order = list(VIEWS)
    wanted, queue = set(), [body]
    while queue:
        for v in _needs(queue.pop()) - wanted:
            wanted.add(v)
            queue.append(VIEWS[v])
    ctes = [f"{v} AS ({VIEWS[v]})" for v in order if v in wanted]
    if not ctes:
        return body
    prefix = "WITH " + ",\n".join(ctes)
    if body[:5].upper() == "WITH ":
        return prefix + ",\n" + body[5:]
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + prefix[5:] + ",\n" + body[15:]
    return prefix + "\n" + body


def file(name: str) -> str:
    return sql((SQL_DIR / f"{name}.sql").read_text())
