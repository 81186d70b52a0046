WITH panel AS (
    SELECT s.symbol, s.date, cash_and_equivalents, debt_repayment, depreciation_and_amortization, ebitda, goodwill_and_intangibles, interest_expense, interest_income, long_term_debt, net_income, operating_cash_flow, operating_income, revenue, total_assets, total_debt, total_stockholders_equity
    FROM quarterly AS s
),
stepped AS (
    SELECT *,
        lag(net_income, 1) OVER w AS net_income_1_ago,
        lag(operating_income, 1) OVER w AS operating_income_1_ago,
        lag(revenue, 1) OVER w AS revenue_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((total_debt / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS debt_to_equity_derived,
    floor((total_debt / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS debt_to_assets_derived,
    floor((total_assets / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS equity_multiplier,
    floor((long_term_debt / nullif(long_term_debt + total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS lt_debt_to_cap,
    floor(((ebitda - depreciation_and_amortization) / nullif(interest_expense, 0)) * 1e6 + 0.51) / 1e6 AS interest_coverage,
    floor((ebitda / nullif(interest_expense, 0)) * 1e6 + 0.51) / 1e6 AS ebitda_interest_coverage,
    floor((operating_cash_flow / nullif(interest_expense, 0)) * 1e6 + 0.51) / 1e6 AS cf_coverage,
    floor(((ebitda - depreciation_and_amortization + interest_expense) / nullif(interest_expense + debt_repayment, 0)) * 1e6 + 0.51) / 1e6 AS fixed_charge_coverage,
    floor((operating_cash_flow / nullif(interest_expense + debt_repayment, 0)) * 1e6 + 0.51) / 1e6 AS debt_service_coverage,
    floor(((ebitda - depreciation_and_amortization) / nullif(ebitda - depreciation_and_amortization - interest_expense, 0)) * 1e6 + 0.51) / 1e6 AS financial_leverage_dfl,
    floor((CASE WHEN operating_income_1_ago = 0 OR revenue_1_ago = 0 THEN NULL ELSE ((operating_income - operating_income_1_ago) / nullif(abs(operating_income_1_ago), 0)) / nullif((revenue - revenue_1_ago) / nullif(abs(revenue_1_ago), 0), 0) END) * 1e6 + 0.51) / 1e6 AS operating_leverage_dol,
    floor((CASE WHEN net_income_1_ago = 0 OR revenue_1_ago = 0 THEN NULL ELSE ((net_income - net_income_1_ago) / nullif(abs(net_income_1_ago), 0)) / nullif((revenue - revenue_1_ago) / nullif(abs(revenue_1_ago), 0), 0) END) * 1e6 + 0.51) / 1e6 AS combined_leverage_dtl,
    floor(((total_debt - cash_and_equivalents) / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS net_debt_to_equity,
    total_stockholders_equity - goodwill_and_intangibles AS tangible_net_worth,
    floor((total_debt / nullif(total_stockholders_equity - goodwill_and_intangibles, 0)) * 1e6 + 0.51) / 1e6 AS debt_to_tangible_nw,
    floor((interest_income / nullif(interest_expense, 0)) * 1e6 + 0.51) / 1e6 AS interest_income_to_expense,
    floor(((interest_income - interest_expense) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS net_interest_margin
FROM stepped
