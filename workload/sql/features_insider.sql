WITH panel AS (
    SELECT s.symbol, s.date, acquisition_or_disposition, insider_price, securities_transacted, type_of_owner
    FROM insider_trades AS s
)
SELECT symbol, date,
    floor((insider_price * securities_transacted) * 1e6 + 0.51) / 1e6 AS insider_trade_value,
    floor((CASE WHEN acquisition_or_disposition = 'A' THEN insider_price * securities_transacted ELSE 0 END) * 1e6 + 0.51) / 1e6 AS insider_buy_value,
    floor((CASE WHEN acquisition_or_disposition = 'D' THEN insider_price * securities_transacted ELSE 0 END) * 1e6 + 0.51) / 1e6 AS insider_sell_value,
    floor((CASE WHEN acquisition_or_disposition = 'A' THEN insider_price * securities_transacted WHEN acquisition_or_disposition = 'D' THEN -(insider_price * securities_transacted) ELSE 0 END) * 1e6 + 0.51) / 1e6 AS insider_net_flow,
    CAST(CASE WHEN acquisition_or_disposition = 'A' THEN securities_transacted ELSE 0 END AS BIGINT) AS insider_shares_bought,
    CAST(CASE WHEN acquisition_or_disposition = 'D' THEN securities_transacted ELSE 0 END AS BIGINT) AS insider_shares_sold,
    CAST(CASE WHEN type_of_owner LIKE '%officer%' OR type_of_owner LIKE '%director%' THEN 1 ELSE 0 END AS INTEGER) AS insider_is_officer
FROM panel
