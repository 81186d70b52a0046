WITH panel AS (
    SELECT s.symbol, s.date, cash_and_equivalents, dcf_val, depreciation_and_amortization, dividends_paid, ebitda, enterprise_value, eps_diluted, est_eps_avg, free_cash_flow, goodwill_and_intangibles, gross_profit, market_cap, net_income, operating_cash_flow, price, revenue, share_repurchase, total_assets, total_current_assets, total_current_liabilities, total_debt, total_liabilities, total_stockholders_equity, weighted_avg_shares_diluted
    FROM quarterly AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
)
SELECT symbol, date,
    floor((market_cap / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS pe_derived,
    floor(((price / nullif(eps_diluted, 0)) / nullif(((est_eps_avg - eps_diluted) / nullif(abs(eps_diluted), 0)) * 100, 0)) * 1e6 + 0.51) / 1e6 AS peg_ratio,
    floor((market_cap / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS price_to_sales_derived,
    floor((market_cap / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS price_to_book,
    floor((market_cap / nullif(total_stockholders_equity - goodwill_and_intangibles, 0)) * 1e6 + 0.51) / 1e6 AS price_to_tangible_book,
    floor((market_cap / nullif(operating_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS price_to_cf,
    floor((market_cap / nullif(free_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS price_to_fcf,
    floor((enterprise_value / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_revenue,
    floor((enterprise_value / nullif(ebitda, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_ebitda_derived,
    floor((enterprise_value / nullif(ebitda - depreciation_and_amortization, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_ebit,
    floor((enterprise_value / nullif(free_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_fcf_derived,
    floor((enterprise_value / nullif(total_debt + total_stockholders_equity - cash_and_equivalents, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_ic,
    floor((enterprise_value / nullif(gross_profit, 0)) * 1e6 + 0.51) / 1e6 AS ev_to_gross_profit,
    floor((net_income / nullif(market_cap, 0)) * 1e6 + 0.51) / 1e6 AS earnings_yield_derived,
    floor((free_cash_flow / nullif(market_cap, 0)) * 1e6 + 0.51) / 1e6 AS fcf_yield_derived,
    floor(((-share_repurchase - dividends_paid) / nullif(market_cap, 0)) * 1e6 + 0.51) / 1e6 AS shareholder_yield,
    floor(((market_cap + total_liabilities) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS tobins_q,
    floor((enterprise_value / nullif(weighted_avg_shares_diluted, 0)) * 1e6 + 0.51) / 1e6 AS ev_per_share,
    floor((market_cap / nullif(total_current_assets - total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS price_to_working_capital,
    floor((dcf_val) * 1e6 + 0.51) / 1e6 AS dcf_value,
    floor(((dcf_val - price) / nullif(price, 0)) * 1e6 + 0.51) / 1e6 AS dcf_upside,
    floor(((dcf_val - price) / nullif(dcf_val, 0)) * 1e6 + 0.51) / 1e6 AS dcf_margin_of_safety
FROM panel
