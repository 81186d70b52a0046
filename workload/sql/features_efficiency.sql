WITH panel AS (
    SELECT s.symbol, s.date, accounts_payable, capex, cash_and_equivalents, cost_of_revenue, depreciation_and_amortization, employee_count_val, gross_profit, inventory, net_income, net_receivables, operating_expenses, property_plant_equipment, rd_expenses, revenue, sga_expenses, total_assets, total_current_assets, total_current_liabilities, total_debt, total_stockholders_equity
    FROM quarterly AS s
    ASOF LEFT JOIN annual ON s.symbol = annual.symbol AND s.date >= annual.date
)
SELECT symbol, date,
    floor((revenue / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS asset_turnover_derived,
    floor((revenue / nullif(property_plant_equipment, 0)) * 1e6 + 0.51) / 1e6 AS fixed_asset_turnover,
    floor((cost_of_revenue / nullif(inventory, 0)) * 1e6 + 0.51) / 1e6 AS inventory_turnover,
    floor((inventory / nullif(cost_of_revenue / 365.0, 0)) * 1e6 + 0.51) / 1e6 AS dio,
    floor((revenue / nullif(net_receivables, 0)) * 1e6 + 0.51) / 1e6 AS receivables_turnover,
    floor((net_receivables / nullif(revenue / 365.0, 0)) * 1e6 + 0.51) / 1e6 AS dso,
    floor((cost_of_revenue / nullif(accounts_payable, 0)) * 1e6 + 0.51) / 1e6 AS payables_turnover,
    floor((accounts_payable / nullif(cost_of_revenue / 365.0, 0)) * 1e6 + 0.51) / 1e6 AS dpo,
    floor(((inventory / nullif(cost_of_revenue / 365.0, 0)) + (net_receivables / nullif(revenue / 365.0, 0)) - (accounts_payable / nullif(cost_of_revenue / 365.0, 0))) * 1e6 + 0.51) / 1e6 AS ccc,
    floor((revenue / nullif(total_current_assets - total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS working_capital_turnover,
    floor((revenue / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS equity_turnover,
    floor((revenue / nullif(total_debt + total_stockholders_equity - cash_and_equivalents, 0)) * 1e6 + 0.51) / 1e6 AS capital_turnover,
    floor((revenue / nullif(employee_count_val, 0)) * 1e6 + 0.51) / 1e6 AS revenue_per_employee,
    floor((net_income / nullif(employee_count_val, 0)) * 1e6 + 0.51) / 1e6 AS net_income_per_employee,
    floor((operating_expenses / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS opex_ratio,
    floor((sga_expenses / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS sga_to_revenue,
    floor((rd_expenses / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS rd_to_revenue,
    floor((rd_expenses / nullif(gross_profit, 0)) * 1e6 + 0.51) / 1e6 AS rd_to_gross_profit,
    floor((abs(capex) / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS capex_to_revenue,
    floor((abs(capex) / nullif(depreciation_and_amortization, 0)) * 1e6 + 0.51) / 1e6 AS capex_to_depreciation
FROM panel
