WITH panel AS (
    SELECT s.symbol, inst_holders_change, inst_holders_count, inst_holders_prev, inst_invested_change, inst_invested_prev, inst_put_call_ratio, inst_total_invested
    FROM snapshot AS s
)
SELECT symbol,
    CAST(inst_holders_count AS INTEGER) AS inst_holders,
    CAST(inst_holders_change AS INTEGER) AS inst_holders_delta,
    CAST(inst_total_invested AS BIGINT) AS inst_invested,
    CAST(inst_invested_change AS BIGINT) AS inst_invested_delta,
    floor((inst_put_call_ratio) * 1e6 + 0.51) / 1e6 AS inst_put_call,
    floor((inst_holders_change / nullif(abs(inst_holders_prev), 0)) * 1e6 + 0.51) / 1e6 AS inst_holders_growth,
    floor((inst_invested_change / nullif(abs(inst_invested_prev), 0)) * 1e6 + 0.51) / 1e6 AS inst_invested_growth
FROM panel
