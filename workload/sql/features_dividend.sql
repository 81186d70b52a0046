WITH panel AS (
    SELECT s.symbol, s.date, adj_dividend, close, dividends_paid, eps_diluted, free_cash_flow, market_cap, net_income, price, share_repurchase, weighted_avg_shares_diluted
    FROM daily AS s
    ASOF LEFT JOIN quarterly ON s.symbol = quarterly.symbol AND s.date >= quarterly.date
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(adj_dividend, 1) OVER w AS adj_dividend_1_ago,
        lag(adj_dividend, 5) OVER w AS adj_dividend_5_ago,
        lag(close, 1) OVER w AS close_1_ago,
        lag(weighted_avg_shares_diluted, 1) OVER w AS weighted_avg_shares_diluted_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor((adj_dividend * 4 / nullif(price, 0)) * 1e6 + 0.51) / 1e6 AS trailing_dividend_yield,
    floor((adj_dividend / nullif(eps_diluted, 0)) * 1e6 + 0.51) / 1e6 AS dividend_payout_ratio,
    floor((abs(dividends_paid) / nullif(free_cash_flow, 0)) * 1e6 + 0.51) / 1e6 AS fcf_payout_ratio,
    floor((eps_diluted / nullif(adj_dividend, 0)) * 1e6 + 0.51) / 1e6 AS dividend_coverage,
    floor((abs(share_repurchase) / nullif(market_cap, 0)) * 1e6 + 0.51) / 1e6 AS buyback_yield,
    floor(((abs(dividends_paid) + abs(share_repurchase)) / nullif(market_cap, 0)) * 1e6 + 0.51) / 1e6 AS shareholder_yield_total,
    floor(((adj_dividend - adj_dividend_1_ago) / nullif(abs(adj_dividend_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS dividend_growth,
    floor(((weighted_avg_shares_diluted - weighted_avg_shares_diluted_1_ago) / nullif(abs(weighted_avg_shares_diluted_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS net_issuance_rate,
    floor((abs(dividends_paid) / nullif(net_income, 0)) * 1e6 + 0.51) / 1e6 AS dividends_to_net_income,
    floor(((close - close_1_ago) / nullif(close_1_ago, 0) + (adj_dividend / nullif(close, 0))) * 1e6 + 0.51) / 1e6 AS total_shareholder_return_proxy,
    floor((pow(adj_dividend / nullif(adj_dividend_5_ago, 0), 0.2) - 1) * 1e6 + 0.51) / 1e6 AS dividend_cagr_5y
FROM stepped
