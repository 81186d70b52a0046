WITH panel AS (
    SELECT s.symbol, s.date, close, price, quote_volume, volume, year_high, year_low
    FROM daily AS s
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(close, 1) OVER w AS close_1_ago,
        lag(close, 5) OVER w AS close_5_ago,
        lag(close, 21) OVER w AS close_21_ago,
        lag(close, 42) OVER w AS close_42_ago,
        lag(close, 63) OVER w AS close_63_ago,
        lag(close, 126) OVER w AS close_126_ago,
        lag(close, 252) OVER w AS close_252_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    floor(((close - close_1_ago) / nullif(close_1_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_1d,
    floor(((close - close_5_ago) / nullif(close_5_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_5d,
    floor(((close - close_21_ago) / nullif(close_21_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_21d,
    floor(((close - close_63_ago) / nullif(close_63_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_63d,
    floor(((close - close_126_ago) / nullif(close_126_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_126d,
    floor(((close - close_252_ago) / nullif(close_252_ago, 0)) * 1e6 + 0.51) / 1e6 AS return_252d,
    floor(((close_21_ago - close_252_ago) / nullif(close_252_ago, 0)) * 1e6 + 0.51) / 1e6 AS momentum_12_1,
    floor(((price - year_low) / nullif(year_high - year_low, 0)) * 1e6 + 0.51) / 1e6 AS percentile_52w,
    floor((-(close - close_5_ago) / nullif(close_5_ago, 0)) * 1e6 + 0.51) / 1e6 AS short_term_reversal,
    floor((((close - close_1_ago) / nullif(close_1_ago, 0)) * (volume / nullif(quote_volume, 0))) * 1e6 + 0.51) / 1e6 AS volume_price_confirmation,
    floor((-(close - close_5_ago) / nullif(close_5_ago, 0)) * 1e6 + 0.51) / 1e6 AS mean_reversion_5d,
    floor((((close - close_21_ago) / nullif(close_21_ago, 0)) - ((close_21_ago - close_42_ago) / nullif(close_42_ago, 0))) * 1e6 + 0.51) / 1e6 AS acceleration,
    floor((sum(CASE WHEN close > close_1_ago THEN volume ELSE 0 END) OVER w20 / nullif(sum(CASE WHEN close <= close_1_ago THEN volume ELSE 0 END) OVER w20, 0)) * 1e6 + 0.51) / 1e6 AS up_down_volume_ratio_20d,
    floor((sum(CASE WHEN (close - close_1_ago) > 0 THEN 1.0 ELSE 0.0 END) OVER w252 / nullif(252.0, 0)) * 1e6 + 0.51) / 1e6 AS frog_in_pan
FROM stepped
WINDOW w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w252 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)
