WITH panel AS (
    SELECT s.symbol, s.date, capex, depreciation_and_amortization, dividends_paid, free_cash_flow, income_before_tax, income_tax_expense, net_income, operating_cash_flow, operating_income, revenue, total_assets, total_debt, weighted_avg_shares_diluted
    FROM quarterly AS s
),
stepped AS (
    SELECT *,
        lag(capex, 1) OVER w AS capex_1_ago,
        lag(operating_cash_flow, 1) OVER w AS operating_cash_flow_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    operating_cash_flow + capex AS fcf_derived,
    floor((free_cash_flow / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS fcf_margin,
    floor((operating_cash_flow / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS cash_earnings_quality,
    floor((operating_cash_flow / nullif(total_debt, 0)) * 1e6 + 0.51) / 1e6 AS cash_debt_coverage,
    floor((operating_cash_flow / nullif(abs(capex), 0)) * 1e6 + 0.51) / 1e6 AS ocf_to_capex,
    floor((abs(capex) / nullif(operating_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS capex_to_ocf,
    floor(((abs(capex) - depreciation_and_amortization) / nullif(operating_income * (1 - income_tax_expense / nullif(income_before_tax, 0)), 0)) * 1e6 + 0.51) / 1e6 AS reinvestment_rate,
    floor((free_cash_flow / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS cash_conversion_ratio,
    floor(((operating_cash_flow - operating_cash_flow_1_ago) / nullif(abs(operating_cash_flow_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS ocf_growth,
    floor(((capex - capex_1_ago) / nullif(abs(capex_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS capex_growth,
    floor(((net_income - operating_cash_flow) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS sloan_ratio,
    floor((free_cash_flow / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS fcf_to_revenue,
    floor((free_cash_flow / nullif(weighted_avg_shares_diluted, 0)) * 1e6 + 0.51) / 1e6 AS fcf_per_share_derived,
    floor((abs(dividends_paid) / nullif(free_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS dividends_to_fcf
FROM stepped
