WITH panel AS (
    SELECT s.symbol, s.date, buy, earnings_eps, earnings_revenue, eps_diluted, eps_estimated, est_eps_avg, est_revenue_avg, hold, num_analysts_eps, price, provider_rating_score, revenue, revenue_estimated, sell, strong_buy, strong_sell, target_consensus, target_high, target_low, target_median
    FROM quarterly AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
)
SELECT symbol, date,
    floor(((earnings_eps - eps_estimated) / nullif(abs(eps_estimated), 0)) * 1e6 + 0.51) / 1e6 AS earnings_surprise_pct,
    floor(((earnings_revenue - revenue_estimated) / nullif(abs(revenue_estimated), 0)) * 1e6 + 0.51) / 1e6 AS revenue_surprise_pct,
    CAST(CASE WHEN earnings_eps > eps_estimated THEN 1 WHEN earnings_eps < eps_estimated THEN -1 ELSE 0 END AS INTEGER) AS eps_surprise_direction,
    CAST(CASE WHEN earnings_revenue > revenue_estimated THEN 1 ELSE 0 END AS INTEGER) AS revenue_beat,
    floor(((target_consensus - price) / nullif(price, 0)) * 1e6 + 0.51) / 1e6 AS target_upside,
    floor(((target_high - target_low) / nullif(target_median, 0)) * 1e6 + 0.51) / 1e6 AS target_dispersion,
    floor(((strong_buy * 5 + buy * 4 + hold * 3 + sell * 2 + strong_sell * 1) / nullif(strong_buy + buy + hold + sell + strong_sell, 0)) * 1e6 + 0.51) / 1e6 AS consensus_score,
    CAST(num_analysts_eps AS INTEGER) AS analyst_coverage,
    floor(((est_eps_avg - eps_diluted) / nullif(abs(eps_diluted), 0)) * 1e6 + 0.51) / 1e6 AS est_eps_growth,
    floor(((est_revenue_avg - revenue) / nullif(abs(revenue), 0)) * 1e6 + 0.51) / 1e6 AS est_revenue_growth,
    floor((price / nullif(est_eps_avg, 0)) * 1e6 + 0.51) / 1e6 AS forward_pe,
    CAST(provider_rating_score AS INTEGER) AS provider_rating_val
FROM panel
