WITH panel AS (
    SELECT s.symbol, s.date, accounts_payable, cash_and_equivalents, cost_of_revenue, ebitda, inventory, net_receivables, operating_cash_flow, operating_expenses, revenue, short_term_investments, total_assets, total_current_assets, total_current_liabilities, total_debt
    FROM quarterly AS s
)
SELECT symbol, date,
    floor((total_current_assets / nullif(total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS current_ratio_derived,
    floor(((total_current_assets - inventory) / nullif(total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS quick_ratio,
    floor(((cash_and_equivalents + short_term_investments) / nullif(total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS cash_ratio,
    total_current_assets - total_current_liabilities AS working_capital,
    floor(((total_current_assets - total_current_liabilities) / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS working_capital_to_revenue,
    floor(((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS nwc_to_total_assets,
    floor(((cash_and_equivalents + short_term_investments + net_receivables) / nullif(operating_expenses / 365.0, 0)) * 1e6 + 0.51) / 1e6 AS defensive_interval,
    floor(((inventory / nullif(cost_of_revenue / 365.0, 0)) + (net_receivables / nullif(revenue / 365.0, 0)) - (accounts_payable / nullif(cost_of_revenue / 365.0, 0))) * 1e6 + 0.51) / 1e6 AS cash_conversion_cycle,
    floor((operating_cash_flow / nullif(total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS ocf_ratio,
    total_debt - cash_and_equivalents AS net_debt_derived,
    floor(((total_debt - cash_and_equivalents) / nullif(ebitda, 0)) * 1e6 + 0.51) / 1e6 AS net_debt_to_ebitda,
    floor((operating_cash_flow / 12.0) * 1e6 + 0.51) / 1e6 AS cash_burn_rate,
    floor((cash_and_equivalents / nullif(-operating_cash_flow / 12.0, 0)) * 1e6 + 0.51) / 1e6 AS cash_runway_months
FROM panel
