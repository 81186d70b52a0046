WITH panel AS (
    SELECT s.symbol, s.date, cash_and_equivalents, close, depreciation_and_amortization, dividends_paid, ebitda, free_cash_flow, hist_buy, hist_hold, hist_inst_holders, hist_inst_holders_change, hist_inst_invested, hist_inst_invested_change, hist_market_cap, hist_sell, hist_strong_buy, hist_strong_sell, net_income, retained_earnings, revenue, total_assets, total_current_assets, total_current_liabilities, total_debt, total_liabilities, total_stockholders_equity
    FROM daily AS s
    ASOF LEFT JOIN quarterly ON s.symbol = quarterly.symbol AND s.date >= quarterly.date
    ASOF LEFT JOIN monthly ON s.symbol = monthly.symbol AND s.date >= monthly.date
),
stepped AS (
    SELECT *,
        lag(hist_market_cap, 1) OVER w AS hist_market_cap_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((hist_market_cap / nullif(close, 0)) * 1e6 + 0.51) / 1e6 AS hist_shares_outstanding,
    floor((hist_market_cap / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS hist_pe_daily,
    floor((hist_market_cap / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS hist_ps_daily,
    floor((hist_market_cap / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS hist_pb_daily,
    CAST(hist_market_cap + total_debt - cash_and_equivalents AS BIGINT) AS hist_ev_daily,
    floor(((hist_market_cap + total_debt - cash_and_equivalents) / nullif(ebitda, 0)) * 1e6 + 0.51) / 1e6 AS hist_ev_to_ebitda_daily,
    floor(((hist_market_cap + total_debt - cash_and_equivalents) / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS hist_ev_to_revenue_daily,
    floor(((hist_market_cap + total_debt - cash_and_equivalents) / nullif(free_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS hist_ev_to_fcf_daily,
    floor((net_income / nullif(hist_market_cap, 0)) * 1e6 + 0.51) / 1e6 AS hist_earnings_yield_daily,
    floor((free_cash_flow / nullif(hist_market_cap, 0)) * 1e6 + 0.51) / 1e6 AS hist_fcf_yield_daily,
    floor(((hist_market_cap - hist_market_cap_1_ago) / nullif(abs(hist_market_cap_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS hist_market_cap_growth,
    floor((abs(dividends_paid) / nullif(hist_market_cap, 0)) * 1e6 + 0.51) / 1e6 AS hist_dividend_yield_daily,
    floor((1.2 * ((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) + 1.4 * (retained_earnings / nullif(total_assets, 0)) + 3.3 * ((ebitda - depreciation_and_amortization) / nullif(total_assets, 0)) + 0.6 * (hist_market_cap / nullif(total_liabilities, 0)) + 1.0 * (revenue / nullif(total_assets, 0))) * 1e6 + 0.51) / 1e6 AS hist_altman_z_daily,
    floor(((hist_strong_buy * 5.0 + hist_buy * 4.0 + hist_hold * 3.0 + hist_sell * 2.0 + hist_strong_sell * 1.0) / nullif(hist_strong_buy + hist_buy + hist_hold + hist_sell + hist_strong_sell, 0)) * 1e6 + 0.51) / 1e6 AS hist_consensus_score,
    floor(((hist_strong_buy + hist_buy) * 1.0 / nullif(hist_strong_buy + hist_buy + hist_hold + hist_sell + hist_strong_sell, 0)) * 1e6 + 0.51) / 1e6 AS hist_buy_pct,
    floor(((hist_sell + hist_strong_sell) * 1.0 / nullif(hist_strong_buy + hist_buy + hist_hold + hist_sell + hist_strong_sell, 0)) * 1e6 + 0.51) / 1e6 AS hist_sell_pct,
    CAST(hist_strong_buy + hist_buy + hist_hold + hist_sell + hist_strong_sell AS INTEGER) AS hist_analyst_count,
    floor((hist_inst_holders_change / nullif(abs(hist_inst_holders - hist_inst_holders_change), 0)) * 1e6 + 0.51) / 1e6 AS hist_inst_ownership_growth,
    floor((hist_inst_invested_change / nullif(abs(hist_inst_invested - hist_inst_invested_change), 0)) * 1e6 + 0.51) / 1e6 AS hist_inst_investment_growth
FROM stepped
