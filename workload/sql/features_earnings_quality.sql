WITH panel AS (
    SELECT s.symbol, s.date, deferred_revenue, earnings_eps, earnings_revenue, eps_estimated, goodwill, goodwill_and_intangibles, gross_profit, inventory, net_income, net_receivables, operating_cash_flow, property_plant_equipment, revenue, revenue_estimated, total_assets, total_current_assets
    FROM quarterly AS s
),
stepped AS (
    SELECT *,
        lag(deferred_revenue, 1) OVER w AS deferred_revenue_1_ago,
        lag(goodwill, 1) OVER w AS goodwill_1_ago,
        lag(gross_profit, 1) OVER w AS gross_profit_1_ago,
        lag(inventory, 1) OVER w AS inventory_1_ago,
        lag(net_receivables, 1) OVER w AS net_receivables_1_ago,
        lag(revenue, 1) OVER w AS revenue_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor(((net_income - operating_cash_flow) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS sloan_accrual_cf,
    floor((operating_cash_flow / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS cash_to_accruals,
    floor((net_receivables / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS receivables_pct_revenue,
    floor(((net_receivables - net_receivables_1_ago) / nullif(revenue - revenue_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS delta_receivables_revenue,
    floor((inventory / nullif(revenue, 0)) * 1e6 + 0.51) / 1e6 AS inventory_pct_revenue,
    floor(((inventory - inventory_1_ago) / nullif(revenue - revenue_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS delta_inventory_revenue,
    floor(((deferred_revenue - deferred_revenue_1_ago) / nullif(abs(deferred_revenue_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS deferred_revenue_growth,
    floor((goodwill_and_intangibles / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS goodwill_to_assets,
    CAST(CASE WHEN goodwill < goodwill_1_ago THEN 1 ELSE 0 END AS INTEGER) AS goodwill_impairment_flag,
    floor(((total_assets - total_current_assets - property_plant_equipment) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS asset_quality,
    floor(((earnings_eps - eps_estimated) / nullif(abs(eps_estimated), 0)) * 1e6 + 0.51) / 1e6 AS earnings_surprise,
    floor(((earnings_revenue - revenue_estimated) / nullif(abs(revenue_estimated), 0)) * 1e6 + 0.51) / 1e6 AS revenue_surprise,
    CAST(CASE WHEN operating_cash_flow > net_income THEN 1 ELSE 0 END AS INTEGER) AS ocf_exceeds_ni,
    floor(((net_income - operating_cash_flow) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS total_accruals_to_assets,
    floor(((net_receivables / nullif(revenue, 0)) / nullif(net_receivables_1_ago / nullif(revenue_1_ago, 0), 0)) * 1e6 + 0.51) / 1e6 AS dsri,
    floor(((gross_profit_1_ago / nullif(revenue_1_ago, 0)) / nullif(gross_profit / nullif(revenue, 0), 0)) * 1e6 + 0.51) / 1e6 AS gmi,
    CAST(sum(CASE WHEN earnings_eps > eps_estimated THEN 1 ELSE 0 END) OVER w4 AS INTEGER) AS earnings_surprise_streak
FROM stepped
WINDOW w4 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
