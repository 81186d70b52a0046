WITH panel AS (
    SELECT s.symbol, s.date, close, high, low, open, price, volume, year_high, year_low
    FROM daily AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(close, 1) OVER w AS close_1_ago,
        lag(close, 5) OVER w AS close_5_ago,
        lag(close, 21) OVER w AS close_21_ago,
        lag(close, 63) OVER w AS close_63_ago,
        lag(close, 126) OVER w AS close_126_ago,
        lag(close, 252) OVER w AS close_252_ago,
        lag(volume, 1) OVER w AS volume_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor(((year_high - price) / nullif(year_high, 0)) * 1e6 + 0.51) / 1e6 AS distance_52w_high,
    floor(((price - year_low) / nullif(year_low, 0)) * 1e6 + 0.51) / 1e6 AS distance_52w_low,
    floor(((high - low) / nullif(open, 0)) * 1e6 + 0.51) / 1e6 AS candlestick_range,
    floor(((close - open) / nullif(open, 0)) * 1e6 + 0.51) / 1e6 AS intraday_return,
    floor(((volume - volume_1_ago) / nullif(volume_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS volume_rate_of_change,
    floor(((close - close_1_ago) * volume) * 1e6 + 0.51) / 1e6 AS force_index,
    floor((CASE WHEN close > close_1_ago THEN volume WHEN close < close_1_ago THEN -volume ELSE 0 END) * 1e6 + 0.51) / 1e6 AS obv_direction,
    floor(((close - close_5_ago) / nullif(close_5_ago, 0)) * 1e6 + 0.51) / 1e6 AS price_momentum_5d,
    floor(((close - close_21_ago) / nullif(close_21_ago, 0)) * 1e6 + 0.51) / 1e6 AS price_momentum_21d,
    floor(((close - close_63_ago) / nullif(close_63_ago, 0)) * 1e6 + 0.51) / 1e6 AS price_momentum_63d,
    floor(((close - close_126_ago) / nullif(close_126_ago, 0)) * 1e6 + 0.51) / 1e6 AS price_momentum_126d,
    floor(((close - close_252_ago) / nullif(close_252_ago, 0)) * 1e6 + 0.51) / 1e6 AS price_momentum_252d,
    floor((max(high) OVER w20) * 1e6 + 0.51) / 1e6 AS rolling_high_20d,
    floor((min(low) OVER w20) * 1e6 + 0.51) / 1e6 AS rolling_low_20d,
    floor((avg(close) OVER w20) * 1e6 + 0.51) / 1e6 AS sma_20,
    floor((avg(close) OVER w50) * 1e6 + 0.51) / 1e6 AS sma_50,
    floor((avg(close) OVER w200) * 1e6 + 0.51) / 1e6 AS sma_200,
    floor((close / nullif(avg(close) OVER w20, 0)) * 1e6 + 0.51) / 1e6 AS price_to_sma_20,
    floor((close / nullif(avg(close) OVER w50, 0)) * 1e6 + 0.51) / 1e6 AS price_to_sma_50,
    floor((close / nullif(avg(close) OVER w200, 0)) * 1e6 + 0.51) / 1e6 AS price_to_sma_200,
    floor((avg(close) OVER w50 / nullif(avg(close) OVER w200, 0)) * 1e6 + 0.51) / 1e6 AS sma_50_to_200,
    CAST(CASE WHEN avg(close) OVER w50 > avg(close) OVER w200 THEN 1 ELSE 0 END AS INTEGER) AS golden_cross_flag,
    floor((avg(close) OVER w20 + 2 * stddev_samp(close) OVER w20) * 1e6 + 0.51) / 1e6 AS bollinger_upper,
    floor((avg(close) OVER w20 - 2 * stddev_samp(close) OVER w20) * 1e6 + 0.51) / 1e6 AS bollinger_lower,
    floor(((close - (avg(close) OVER w20 - 2 * stddev_samp(close) OVER w20)) / nullif(4 * stddev_samp(close) OVER w20, 0)) * 1e6 + 0.51) / 1e6 AS bollinger_pct_b,
    floor(((4 * stddev_samp(close) OVER w20) / nullif(avg(close) OVER w20, 0)) * 1e6 + 0.51) / 1e6 AS bollinger_bandwidth,
    floor((((close - low) - (high - close)) / nullif(high - low, 0) * volume) * 1e6 + 0.51) / 1e6 AS accumulation_distribution,
    floor((((close - low) - (high - close)) / nullif(high - low, 0)) * 1e6 + 0.51) / 1e6 AS money_flow_multiplier,
    CAST(sum(CASE WHEN close > close_1_ago THEN volume WHEN close < close_1_ago THEN -volume ELSE 0 END) OVER w_all AS BIGINT) AS obv_cumulative,
    floor((sum(((close - low) - (high - close)) / nullif(high - low, 0) * volume) OVER w20 / nullif(sum(volume) OVER w20, 0)) * 1e6 + 0.51) / 1e6 AS chaikin_money_flow_20d
FROM stepped
WINDOW w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w50 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
    w200 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
    w_all AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)
