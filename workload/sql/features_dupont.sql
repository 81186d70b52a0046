WITH panel AS (
    SELECT s.symbol, s.date, income_before_tax, net_income, operating_income, revenue, total_assets, total_stockholders_equity
    FROM quarterly AS s
)
SELECT symbol, date,
    floor((net_income / nullif(income_before_tax, 0)) * 1e6 + 0.51) / 1e6 AS tax_burden,
    floor((income_before_tax / nullif(operating_income, 0)) * 1e6 + 0.51) / 1e6 AS interest_burden,
    floor((operating_income / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS dupont_operating_margin,
    floor((revenue / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS dupont_asset_turnover,
    floor((total_assets / nullif(total_stockholders_equity, 0)) * 1e6 + 0.51) / 1e6 AS dupont_equity_multiplier,
    floor(((net_income / nullif(revenue, 0)) * (revenue / nullif(total_assets, 0)) * (total_assets / nullif(total_stockholders_equity, 0))) * 1e6 + 0.51) / 1e6 AS roe_3factor,
    floor(((net_income / nullif(income_before_tax, 0)) * (income_before_tax / nullif(operating_income, 0)) * (operating_income / nullif(revenue, 0)) * (revenue / nullif(total_assets, 0)) * (total_assets / nullif(total_stockholders_equity, 0))) * 1e6 + 0.51) / 1e6 AS roe_5factor
FROM panel
