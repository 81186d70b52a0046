WITH panel AS (
    SELECT s.symbol, s.date, adj_dividend, capex, dividends_paid, ebitda, eps_diluted, free_cash_flow, gross_profit, market_cap, net_income, operating_income, rd_expenses, revenue, sga_expenses, total_assets, total_current_assets, total_current_liabilities, total_debt, total_stockholders_equity, weighted_avg_shares_diluted
    FROM quarterly AS s
),
stepped AS (
    SELECT *,
        lag(adj_dividend, 3) OVER w AS adj_dividend_3_ago,
        lag(adj_dividend, 5) OVER w AS adj_dividend_5_ago,
        lag(capex, 1) OVER w AS capex_1_ago,
        lag(ebitda, 1) OVER w AS ebitda_1_ago,
        lag(eps_diluted, 1) OVER w AS eps_diluted_1_ago,
        lag(eps_diluted, 3) OVER w AS eps_diluted_3_ago,
        lag(eps_diluted, 5) OVER w AS eps_diluted_5_ago,
        lag(eps_diluted, 10) OVER w AS eps_diluted_10_ago,
        lag(free_cash_flow, 1) OVER w AS free_cash_flow_1_ago,
        lag(gross_profit, 1) OVER w AS gross_profit_1_ago,
        lag(market_cap, 1) OVER w AS market_cap_1_ago,
        lag(net_income, 1) OVER w AS net_income_1_ago,
        lag(operating_income, 1) OVER w AS operating_income_1_ago,
        lag(rd_expenses, 1) OVER w AS rd_expenses_1_ago,
        lag(revenue, 1) OVER w AS revenue_1_ago,
        lag(revenue, 3) OVER w AS revenue_3_ago,
        lag(revenue, 5) OVER w AS revenue_5_ago,
        lag(revenue, 10) OVER w AS revenue_10_ago,
        lag(sga_expenses, 1) OVER w AS sga_expenses_1_ago,
        lag(total_assets, 1) OVER w AS total_assets_1_ago,
        lag(total_current_assets, 1) OVER w AS total_current_assets_1_ago,
        lag(total_current_liabilities, 1) OVER w AS total_current_liabilities_1_ago,
        lag(total_debt, 1) OVER w AS total_debt_1_ago,
        lag(total_stockholders_equity, 1) OVER w AS total_stockholders_equity_1_ago,
        lag(weighted_avg_shares_diluted, 1) OVER w AS weighted_avg_shares_diluted_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((((revenue) - revenue_1_ago) / nullif(abs(revenue_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS revenue_growth_yoy,
    floor((((gross_profit) - gross_profit_1_ago) / nullif(abs(gross_profit_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS gross_profit_growth,
    floor((((operating_income) - operating_income_1_ago) / nullif(abs(operating_income_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS operating_income_growth,
    floor((((ebitda) - ebitda_1_ago) / nullif(abs(ebitda_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS ebitda_growth,
    floor((((net_income) - net_income_1_ago) / nullif(abs(net_income_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS net_income_growth,
    floor((((eps_diluted) - eps_diluted_1_ago) / nullif(abs(eps_diluted_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS eps_growth_yoy,
    floor((((free_cash_flow) - free_cash_flow_1_ago) / nullif(abs(free_cash_flow_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS fcf_growth,
    floor((((total_assets) - total_assets_1_ago) / nullif(abs(total_assets_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS asset_growth,
    floor((((total_stockholders_equity) - total_stockholders_equity_1_ago) / nullif(abs(total_stockholders_equity_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS book_value_growth,
    floor(((net_income / nullif(total_stockholders_equity, 0)) * (1 - abs(dividends_paid) / nullif(net_income, 0))) * 1e6 + 0.51) / 1e6 AS sustainable_growth_rate,
    floor((((revenue) - revenue_1_ago) / nullif(abs(revenue_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS sequential_revenue_growth,
    floor(((operating_income / nullif(revenue, 0)) - (operating_income_1_ago / nullif(revenue_1_ago, 0))) * 1e6 + 0.51) / 1e6 AS operating_margin_change,
    floor(((net_income / nullif(revenue, 0)) - (net_income_1_ago / nullif(revenue_1_ago, 0))) * 1e6 + 0.51) / 1e6 AS net_margin_change,
    floor(((total_debt / nullif(total_stockholders_equity, 0)) - (total_debt_1_ago / nullif(total_stockholders_equity_1_ago, 0))) * 1e6 + 0.51) / 1e6 AS debt_to_equity_change,
    floor(((total_current_assets / nullif(total_current_liabilities, 0)) - (total_current_assets_1_ago / nullif(total_current_liabilities_1_ago, 0))) * 1e6 + 0.51) / 1e6 AS current_ratio_change,
    floor((((abs(capex)) - (abs(capex_1_ago))) / nullif(abs((abs(capex_1_ago))), 0)) * 1e6 + 0.51) / 1e6 AS capex_growth_rate,
    floor((((rd_expenses) - rd_expenses_1_ago) / nullif(abs(rd_expenses_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS rd_growth,
    floor((((sga_expenses) - sga_expenses_1_ago) / nullif(abs(sga_expenses_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS sga_growth,
    (total_current_assets - total_current_liabilities) - (total_current_assets_1_ago - total_current_liabilities_1_ago) AS working_capital_change,
    floor((((weighted_avg_shares_diluted) - weighted_avg_shares_diluted_1_ago) / nullif(abs(weighted_avg_shares_diluted_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS share_count_change,
    floor((pow(revenue / nullif(revenue_3_ago, 0), 1.0 / 3) - 1) * 1e6 + 0.51) / 1e6 AS revenue_cagr_3y,
    floor((pow(revenue / nullif(revenue_5_ago, 0), 1.0 / 5) - 1) * 1e6 + 0.51) / 1e6 AS revenue_cagr_5y,
    floor((pow(abs(eps_diluted) / nullif(abs(eps_diluted_3_ago), 0), 1.0 / 3) - 1) * 1e6 + 0.51) / 1e6 AS eps_cagr_3y,
    floor((pow(abs(eps_diluted) / nullif(abs(eps_diluted_5_ago), 0), 1.0 / 5) - 1) * 1e6 + 0.51) / 1e6 AS eps_cagr_5y,
    floor((pow(adj_dividend / nullif(adj_dividend_3_ago, 0), 1.0 / 3) - 1) * 1e6 + 0.51) / 1e6 AS dividend_growth_3y,
    floor(((market_cap - market_cap_1_ago) / nullif(abs(market_cap_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS market_cap_growth,
    floor((pow(revenue / nullif(revenue_10_ago, 0), 1.0 / 10) - 1) * 1e6 + 0.51) / 1e6 AS revenue_cagr_10y,
    floor((pow(abs(eps_diluted) / nullif(abs(eps_diluted_10_ago), 0), 1.0 / 10) - 1) * 1e6 + 0.51) / 1e6 AS eps_cagr_10y,
    floor((pow(adj_dividend / nullif(adj_dividend_5_ago, 0), 1.0 / 5) - 1) * 1e6 + 0.51) / 1e6 AS dividend_growth_5y,
    floor((stddev_samp(((revenue - revenue_1_ago) / nullif(abs(revenue_1_ago), 0))) OVER w5) * 1e6 + 0.51) / 1e6 AS revenue_growth_consistency
FROM stepped
WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
