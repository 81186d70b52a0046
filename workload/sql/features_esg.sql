WITH panel AS (
    SELECT s.symbol, esg_environmental, esg_governance, esg_score, esg_social
    FROM snapshot AS s
)
SELECT symbol,
    floor((esg_score) * 1e6 + 0.51) / 1e6 AS esg_composite,
    floor((esg_environmental) * 1e6 + 0.51) / 1e6 AS esg_env,
    floor((esg_social) * 1e6 + 0.51) / 1e6 AS esg_soc,
    floor((esg_governance) * 1e6 + 0.51) / 1e6 AS esg_gov
FROM panel
