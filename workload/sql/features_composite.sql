WITH panel AS (
    SELECT s.symbol, s.date, cost_of_revenue, depreciation_and_amortization, ebitda, enterprise_value, eps_diluted, gross_profit, inventory, long_term_debt, market_cap, net_income, net_receivables, operating_cash_flow, other_current_assets, outstanding_shares, price, property_plant_equipment, retained_earnings, revenue, sga_expenses, total_assets, total_current_assets, total_current_liabilities, total_liabilities, total_stockholders_equity, weighted_avg_shares_diluted
    FROM quarterly AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(cost_of_revenue, 1) OVER w AS cost_of_revenue_1_ago,
        lag(depreciation_and_amortization, 1) OVER w AS depreciation_and_amortization_1_ago,
        lag(gross_profit, 1) OVER w AS gross_profit_1_ago,
        lag(inventory, 1) OVER w AS inventory_1_ago,
        lag(long_term_debt, 1) OVER w AS long_term_debt_1_ago,
        lag(net_income, 1) OVER w AS net_income_1_ago,
        lag(net_receivables, 1) OVER w AS net_receivables_1_ago,
        lag(operating_cash_flow, 1) OVER w AS operating_cash_flow_1_ago,
        lag(other_current_assets, 1) OVER w AS other_current_assets_1_ago,
        lag(property_plant_equipment, 1) OVER w AS property_plant_equipment_1_ago,
        lag(revenue, 1) OVER w AS revenue_1_ago,
        lag(sga_expenses, 1) OVER w AS sga_expenses_1_ago,
        lag(total_assets, 1) OVER w AS total_assets_1_ago,
        lag(total_current_assets, 1) OVER w AS total_current_assets_1_ago,
        lag(total_current_liabilities, 1) OVER w AS total_current_liabilities_1_ago,
        lag(total_liabilities, 1) OVER w AS total_liabilities_1_ago,
        lag(weighted_avg_shares_diluted, 1) OVER w AS weighted_avg_shares_diluted_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((1.2 * ((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) + 1.4 * (retained_earnings / nullif(total_assets, 0)) + 3.3 * ((ebitda - depreciation_and_amortization) / nullif(total_assets, 0)) + 0.6 * (market_cap / nullif(total_liabilities, 0)) + 1.0 * (revenue / nullif(total_assets, 0))) * 1e6 + 0.51) / 1e6 AS altman_z_score,
    floor((0.717 * ((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) + 0.847 * (retained_earnings / nullif(total_assets, 0)) + 3.107 * ((ebitda - depreciation_and_amortization) / nullif(total_assets, 0)) + 0.420 * (total_stockholders_equity / nullif(total_liabilities, 0)) + 0.998 * (revenue / nullif(total_assets, 0))) * 1e6 + 0.51) / 1e6 AS altman_z_prime,
    floor((3.25 + 6.56 * ((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) + 3.26 * (retained_earnings / nullif(total_assets, 0)) + 6.72 * ((ebitda - depreciation_and_amortization) / nullif(total_assets, 0)) + 1.05 * (total_stockholders_equity / nullif(total_liabilities, 0))) * 1e6 + 0.51) / 1e6 AS altman_z_double_prime,
    CAST(CASE WHEN net_income > 0 THEN 1 ELSE 0 END + CASE WHEN operating_cash_flow > 0 THEN 1 ELSE 0 END + CASE WHEN (net_income / nullif(total_assets, 0)) > (net_income_1_ago / nullif(total_assets_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN operating_cash_flow > net_income THEN 1 ELSE 0 END + CASE WHEN (long_term_debt / nullif(total_assets, 0)) < (long_term_debt_1_ago / nullif(total_assets_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (total_current_assets / nullif(total_current_liabilities, 0)) > (total_current_assets_1_ago / nullif(total_current_liabilities_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN weighted_avg_shares_diluted <= weighted_avg_shares_diluted_1_ago THEN 1 ELSE 0 END + CASE WHEN (gross_profit / nullif(revenue, 0)) > (gross_profit_1_ago / nullif(revenue_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (revenue / nullif(total_assets, 0)) > (revenue_1_ago / nullif(total_assets_1_ago, 0)) THEN 1 ELSE 0 END AS INTEGER) AS piotroski_f_score,
    floor(((net_receivables / nullif(revenue, 0)) / nullif(net_receivables_1_ago / nullif(revenue_1_ago, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_dsri,
    floor(((gross_profit_1_ago / nullif(revenue_1_ago, 0)) / nullif(gross_profit / nullif(revenue, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_gmi,
    floor((((total_assets - total_current_assets - property_plant_equipment) / nullif(total_assets, 0)) / nullif((total_assets_1_ago - total_current_assets_1_ago - property_plant_equipment_1_ago) / nullif(total_assets_1_ago, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_aqi,
    floor((revenue / nullif(revenue_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS beneish_sgi,
    floor(((depreciation_and_amortization_1_ago / nullif(depreciation_and_amortization_1_ago + property_plant_equipment_1_ago, 0)) / nullif(depreciation_and_amortization / nullif(depreciation_and_amortization + property_plant_equipment, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_depi,
    floor(((sga_expenses / nullif(revenue, 0)) / nullif(sga_expenses_1_ago / nullif(revenue_1_ago, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_sgai,
    floor(((net_income - operating_cash_flow) / nullif(total_assets, 0)) * 1e6 + 0.51) / 1e6 AS beneish_tata,
    floor(((total_liabilities / nullif(total_assets, 0)) / nullif(total_liabilities_1_ago / nullif(total_assets_1_ago, 0), 0)) * 1e6 + 0.51) / 1e6 AS beneish_lvgi,
    floor((-4.84 + 0.920 * ((net_receivables / nullif(revenue, 0)) / nullif(net_receivables_1_ago / nullif(revenue_1_ago, 0), 0)) + 0.528 * ((gross_profit_1_ago / nullif(revenue_1_ago, 0)) / nullif(gross_profit / nullif(revenue, 0), 0)) + 0.404 * (((total_assets - total_current_assets - property_plant_equipment) / nullif(total_assets, 0)) / nullif((total_assets_1_ago - total_current_assets_1_ago - property_plant_equipment_1_ago) / nullif(total_assets_1_ago, 0), 0)) + 0.892 * (revenue / nullif(revenue_1_ago, 0)) + 0.115 * ((depreciation_and_amortization_1_ago / nullif(depreciation_and_amortization_1_ago + property_plant_equipment_1_ago, 0)) / nullif(depreciation_and_amortization / nullif(depreciation_and_amortization + property_plant_equipment, 0), 0)) - 0.172 * ((sga_expenses / nullif(revenue, 0)) / nullif(sga_expenses_1_ago / nullif(revenue_1_ago, 0), 0)) + 4.679 * ((net_income - operating_cash_flow) / nullif(total_assets, 0)) - 0.327 * ((total_liabilities / nullif(total_assets, 0)) / nullif(total_liabilities_1_ago / nullif(total_assets_1_ago, 0), 0))) * 1e6 + 0.51) / 1e6 AS beneish_m_score,
    floor((sqrt(22.5 * abs(eps_diluted) * abs(total_stockholders_equity / nullif(outstanding_shares, 0)))) * 1e6 + 0.51) / 1e6 AS graham_number,
    floor(((sqrt(22.5 * abs(eps_diluted) * abs(total_stockholders_equity / nullif(outstanding_shares, 0))) - price) / nullif(price, 0)) * 1e6 + 0.51) / 1e6 AS graham_margin_of_safety,
    floor(((ebitda - depreciation_and_amortization) / nullif(enterprise_value, 0)) * 1e6 + 0.51) / 1e6 AS earnings_yield_magic,
    floor(((ebitda - depreciation_and_amortization) / nullif(property_plant_equipment + total_current_assets - total_current_liabilities, 0)) * 1e6 + 0.51) / 1e6 AS return_on_capital_magic,
    floor((enterprise_value / nullif(ebitda, 0)) * 1e6 + 0.51) / 1e6 AS acquirers_multiple,
    CAST(CASE WHEN net_income > net_income_1_ago AND operating_cash_flow < operating_cash_flow_1_ago THEN 1 ELSE 0 END + CASE WHEN (net_receivables / nullif(revenue, 0)) > (net_receivables_1_ago / nullif(revenue_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (inventory / nullif(cost_of_revenue, 0)) > (inventory_1_ago / nullif(cost_of_revenue_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (other_current_assets / nullif(revenue, 0)) > (other_current_assets_1_ago / nullif(revenue_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (depreciation_and_amortization / nullif(depreciation_and_amortization + property_plant_equipment, 0)) < (depreciation_and_amortization_1_ago / nullif(depreciation_and_amortization_1_ago + property_plant_equipment_1_ago, 0)) THEN 1 ELSE 0 END + CASE WHEN (total_assets - total_assets_1_ago) / nullif(abs(total_assets_1_ago), 0) > 0.10 THEN 1 ELSE 0 END AS INTEGER) AS montier_c_score,
    floor((-1.32 - 0.407 * ln(total_assets / 1000000.0) + 6.03 * (total_liabilities / nullif(total_assets, 0)) - 1.43 * ((total_current_assets - total_current_liabilities) / nullif(total_assets, 0)) + 0.076 * (total_current_liabilities / nullif(total_current_assets, 0)) - 1.72 * (CASE WHEN total_liabilities > total_assets THEN 1 ELSE 0 END) - 2.37 * (net_income / nullif(total_assets, 0)) - 1.83 * (operating_cash_flow / nullif(total_liabilities, 0)) + 0.285 * (CASE WHEN net_income < 0 AND net_income_1_ago < 0 THEN 1 ELSE 0 END) - 0.521 * ((net_income - net_income_1_ago) / nullif(abs(net_income) + abs(net_income_1_ago), 0))) * 1e6 + 0.51) / 1e6 AS ohlson_o_score
FROM stepped
