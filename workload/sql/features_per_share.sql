WITH panel AS (
    SELECT s.symbol, s.date, adj_dividend, cash_and_equivalents, enterprise_value, free_cash_flow, goodwill_and_intangibles, net_income, operating_cash_flow, outstanding_shares, revenue, total_debt, total_stockholders_equity, weighted_avg_shares, weighted_avg_shares_diluted
    FROM quarterly AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(weighted_avg_shares_diluted, 1) OVER w AS weighted_avg_shares_diluted_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((net_income / nullif(weighted_avg_shares, 0)) * 1e6 + 0.51) / 1e6 AS eps_basic_derived,
    floor((net_income / nullif(weighted_avg_shares_diluted, 0)) * 1e6 + 0.51) / 1e6 AS eps_diluted_derived,
    floor((total_stockholders_equity / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS bvps,
    floor(((total_stockholders_equity - goodwill_and_intangibles) / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS tbvps,
    floor((revenue / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS revenue_per_share_derived,
    floor((operating_cash_flow / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS ocf_per_share,
    floor((free_cash_flow / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS fcf_per_share,
    floor((adj_dividend) * 1e6 + 0.51) / 1e6 AS dividend_per_share,
    floor(((cash_and_equivalents - total_debt) / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS net_cash_per_share,
    floor((enterprise_value / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS ev_per_share_derived,
    floor(((weighted_avg_shares_diluted - weighted_avg_shares_diluted_1_ago) / nullif(abs(weighted_avg_shares_diluted_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS share_dilution_rate
FROM stepped
