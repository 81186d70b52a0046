WITH panel AS (
    SELECT s.date, rate_10y, rate_2y, rate_30y, rate_3m
    FROM rates AS s
)
SELECT date,
    floor((rate_10y) * 1e6 + 0.51) / 1e6 AS yield_10y,
    floor((rate_2y) * 1e6 + 0.51) / 1e6 AS yield_2y,
    floor((rate_10y - rate_2y) * 1e6 + 0.51) / 1e6 AS yield_spread_2s10s,
    floor((rate_30y - rate_3m) * 1e6 + 0.51) / 1e6 AS yield_curve_slope,
    floor((rate_10y - rate_3m) * 1e6 + 0.51) / 1e6 AS yield_spread_10y_3m,
    floor((rate_10y / 100.0) * 1e6 + 0.51) / 1e6 AS risk_free_rate,
    floor((rate_3m / 100.0) * 1e6 + 0.51) / 1e6 AS short_rate,
    floor((rate_30y / 100.0) * 1e6 + 0.51) / 1e6 AS long_rate,
    CAST(CASE WHEN rate_2y > rate_10y THEN 1 ELSE 0 END AS INTEGER) AS yield_curve_inverted
FROM panel
