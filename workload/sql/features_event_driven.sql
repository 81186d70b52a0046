WITH panel AS (
    SELECT s.symbol, s.date, employee_count_val, float_shares, ipo_date, outstanding_shares, price, provider_return_1d, provider_return_1m, provider_return_1y, provider_return_3m, provider_return_3y, provider_return_5d, provider_return_5y, provider_return_6m, provider_return_ytd, split_denominator, split_numerator, year_high, year_low
    FROM quarterly AS s
    ASOF LEFT JOIN annual ON s.symbol = annual.symbol AND s.date >= annual.date
    LEFT JOIN snapshot ON s.symbol = snapshot.symbol
),
stepped AS (
    SELECT *,
        lag(employee_count_val, 1) OVER w AS employee_count_val_1_ago
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)
)
SELECT symbol, date,
    CAST(CAST(DATE '2002-01-01' - ipo_date AS INTEGER) AS INTEGER) AS ipo_age_days,
    CAST(CASE WHEN (year_high - price) / nullif(year_high, 0) < 0.05 THEN 1 ELSE 0 END AS INTEGER) AS near_52w_high,
    CAST(CASE WHEN (price - year_low) / nullif(year_low, 0) < 0.05 THEN 1 ELSE 0 END AS INTEGER) AS near_52w_low,
    floor((float_shares / nullif(outstanding_shares, 0)) * 1e6 + 0.51) / 1e6 AS float_pct,
    floor(((employee_count_val - employee_count_val_1_ago) / nullif(abs(employee_count_val_1_ago), 0)) * 1e6 + 0.51) / 1e6 AS employee_growth,
    floor((provider_return_1d) * 1e6 + 0.51) / 1e6 AS provider_ret_1d,
    floor((provider_return_5d) * 1e6 + 0.51) / 1e6 AS provider_ret_5d,
    floor((provider_return_1m) * 1e6 + 0.51) / 1e6 AS provider_ret_1m,
    floor((provider_return_3m) * 1e6 + 0.51) / 1e6 AS provider_ret_3m,
    floor((provider_return_6m) * 1e6 + 0.51) / 1e6 AS provider_ret_6m,
    floor((provider_return_ytd) * 1e6 + 0.51) / 1e6 AS provider_ret_ytd,
    floor((provider_return_1y) * 1e6 + 0.51) / 1e6 AS provider_ret_1y,
    floor((provider_return_3y) * 1e6 + 0.51) / 1e6 AS provider_ret_3y,
    floor((provider_return_5y) * 1e6 + 0.51) / 1e6 AS provider_ret_5y,
    floor((split_numerator / nullif(split_denominator, 0)) * 1e6 + 0.51) / 1e6 AS split_ratio
FROM stepped
