WITH panel AS (
    SELECT s.symbol, s.date, cash_and_equivalents, depreciation_and_amortization, ebitda, goodwill_and_intangibles, gross_profit, income_before_tax, income_tax_expense, net_income, operating_cash_flow, operating_income, revenue, total_assets, total_current_liabilities, total_debt, total_stockholders_equity
    FROM quarterly AS s
)
SELECT symbol, date,
    floor((gross_profit / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS gross_profit_margin,
    floor((operating_income / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS operating_profit_margin,
    floor((net_income / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS net_profit_margin,
    floor((ebitda / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS ebitda_margin,
    floor(((ebitda - depreciation_and_amortization) / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS ebit_margin,
    floor((net_income / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS return_on_assets,
    floor((net_income / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS return_on_equity,
    floor(((operating_income * (1 - income_tax_expense / nullif(income_before_tax, 0))) / nullif(total_debt + total_stockholders_equity - cash_and_equivalents, 0)) * 1e6 + 0.51) / 1e6 AS roic_derived,
    floor(((ebitda - depreciation_and_amortization) / nullif(total_assets - total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS roce,
    floor((net_income / nullif(total_assets - goodwill_and_intangibles, 0)) * 1e6 + 0.51) / 1e6 AS return_on_tangible_assets,
    floor((net_income / nullif(total_assets - total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS return_on_net_assets,
    floor((operating_income / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS operating_return_on_assets,
    floor((operating_cash_flow / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS cash_return_on_assets,
    floor((operating_cash_flow / nullif(total_debt + total_stockholders_equity - cash_and_equivalents, 0)) * 1e6 + 0.51) / 1e6 AS cash_return_on_ic,
    floor((income_tax_expense / nullif(income_before_tax, 0)) * 1e6 + 0.51) / 1e6 AS effective_tax_rate,
    floor((net_income / nullif(income_before_tax, 0)) * 1e6 + 0.51) / 1e6 AS tax_burden_ratio,
    floor((income_before_tax / nullif(operating_income, 0)) * 1e6 + 0.51) / 1e6 AS interest_burden_ratio,
    floor((operating_income * (1 - income_tax_expense / nullif(income_before_tax, 0))) * 1e6 + 0.51) / 1e6 AS nopat,
    floor(((operating_income * (1 - income_tax_expense / nullif(income_before_tax, 0))) - 0.10 * (total_debt + total_stockholders_equity - cash_and_equivalents)) * 1e6 + 0.51) / 1e6 AS economic_profit_proxy,
    floor(((operating_income * (1 - income_tax_expense / nullif(income_before_tax, 0))) / nullif(total_debt + total_stockholders_equity - cash_and_equivalents, 0) - 0.10) * 1e6 + 0.51) / 1e6 AS roic_wacc_spread
FROM panel
