WITH panel AS (
    SELECT s.symbol, s.date, close, high, low, open, price, quote_volume, rate_10y, year_high, year_low
    FROM daily AS s
    LEFT JOIN rates ON s.date = rates.date
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(close, 1) OVER w AS close_1_ago,
        lag(close, 252) OVER w AS close_252_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor(((close - close_1_ago) / nullif(close_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS daily_return,
    floor((stddev_samp(close / nullif(close_1_ago, 0) - 1) OVER w20 * sqrt(252)) * 1e6 + 0.51) / 1e6 AS historical_volatility_20d,
    floor((stddev_samp(close / nullif(close_1_ago, 0) - 1) OVER w60 * sqrt(252)) * 1e6 + 0.51) / 1e6 AS historical_volatility_60d,
    floor((stddev_samp(close / nullif(close_1_ago, 0) - 1) OVER w252 * sqrt(252)) * 1e6 + 0.51) / 1e6 AS historical_volatility_252d,
    floor(((close - max(close) OVER w252) / nullif(max(close) OVER w252, 0)) * 1e6 + 0.51) / 1e6 AS max_drawdown_252d,
    floor(((year_high - price) / nullif(year_high, 0)) * 1e6 + 0.51) / 1e6 AS distance_from_52w_high,
    floor(((price - year_low) / nullif(year_low, 0)) * 1e6 + 0.51) / 1e6 AS distance_from_52w_low,
    floor((quote_volume / nullif(quote_volume, 0)) * 1e6 + 0.51) / 1e6 AS volume_to_avg,
    floor(((high - low) / nullif(open, 0)) * 1e6 + 0.51) / 1e6 AS price_range_pct,
    floor(((open - close_1_ago) / nullif(close_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS overnight_gap,
    CAST(CASE WHEN close > close_1_ago THEN 1 ELSE 0 END AS INTEGER) AS up_day,
    floor((greatest(high - low, abs(high - close_1_ago), abs(low - close_1_ago))) * 1e6 + 0.51) / 1e6 AS true_range,
    floor((avg(greatest(high - low, abs(high - close_1_ago), abs(low - close_1_ago))) OVER w14) * 1e6 + 0.51) / 1e6 AS atr_14,
    floor((stddev_samp(CASE WHEN close < close_1_ago THEN (close - close_1_ago) / nullif(close_1_ago, 0) ELSE NULL END) OVER w20 * sqrt(252)) * 1e6 + 0.51) / 1e6 AS down_volatility_20d,
    floor((((close / nullif(close_252_ago, 0)) - 1) / nullif(abs((close - max(close) OVER w252) / nullif(max(close) OVER w252, 0)), 0)) * 1e6 + 0.51) / 1e6 AS calmar_ratio,
    floor((quantile_cont((close / nullif(close_1_ago, 0) - 1), 0.05) OVER w252) * 1e6 + 0.51) / 1e6 AS var_95_252d,
    floor((skewness(close / nullif(close_1_ago, 0) - 1) OVER w252) * 1e6 + 0.51) / 1e6 AS skewness_252d,
    floor((kurtosis(close / nullif(close_1_ago, 0) - 1) OVER w252) * 1e6 + 0.51) / 1e6 AS kurtosis_252d,
    floor((((close / nullif(close_252_ago, 0) - 1) - rate_10y / 100.0) / nullif(stddev_samp(close / nullif(close_1_ago, 0) - 1) OVER w252 * sqrt(252), 0)) * 1e6 + 0.51) / 1e6 AS sharpe_ratio_252d,
    floor((((close / nullif(close_252_ago, 0) - 1) - rate_10y / 100.0) / nullif(stddev_samp(CASE WHEN close < close_1_ago THEN close / nullif(close_1_ago, 0) - 1 ELSE NULL END) OVER w252 * sqrt(252), 0)) * 1e6 + 0.51) / 1e6 AS sortino_ratio_252d
FROM stepped
WINDOW w14 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w60 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW),
    w252 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)
