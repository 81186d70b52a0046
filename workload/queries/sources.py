"""Landing, typed append and scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain import BucketedStore, FieldSpec, Grain, PanelQuery, TableSpec, VersionedStore, default_catalog
from panelgrain.plans.session import shared_folder
from panelgrain.sources import landing as L

from .. import oracle as O
from .. import views as V

CATALOG = default_catalog()


def s01_typed_append(spark, sf_dir):
    """Raw insider trades under their payload names appended to a stored table, and read back."""
    t = V.events(spark, sf_dir)
    raw = t.select(
        F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("symbol")).alias("symbol"),
        F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("date").cast("string")).alias(
            "transactionDate"
        ),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").alias("securitiesTransacted"),
        # The misspelt attribute on one part of the rows, the proper one on the rest.
        F.when(F.col("event_id") % 2 == 0, "A").alias("acquistionOrDisposition"),
        F.when(F.col("event_id") % 2 == 1, "D").alias("acquisitionOrDisposition"),
        F.col("event_type").alias("unknownAttribute"),
        F.col("event_id").alias("_seq"),
    )
    store = VersionedStore(spark, f"{shared_folder(spark, 'append')}/store")
    store.append("insider_trades", raw, "2024-02-01 00:00:00", 7)
    return store.frame("insider_trades").select(
        "symbol", "date", "insider_price", "securities_transacted", "acquisition_or_disposition",
        "reporting_name", "_batch_id", "_seq",
    )


S01 = """
SELECT symbol, CASE WHEN event_id % 13 = 0 THEN NULL ELSE date END AS date,
       value AS insider_price, CAST(json_extract(props, '$.k') AS BIGINT) AS securities_transacted,
       CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'D' END AS acquisition_or_disposition,
       CAST(NULL AS VARCHAR) AS reporting_name, '7' AS _batch_id, event_id AS _seq
FROM ev WHERE event_id % 10 <> 0"""


def s02_typed_table(spark, sf_dir):
    """Order lines as raw price rows: every column of the table, typed, absent ones NULL."""
    line = V.table(spark, sf_dir, "lineitem")
    raw = line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("symbol"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").alias("close"), (F.col("l_quantity") / 4).alias("volume"),
        F.col("l_discount").alias("changePercent"), F.col("l_returnflag").alias("unknown"),
    )
    spec = CATALOG["daily_price"]
    out = L.conform(raw, spec)
    if [(f.name, f.dataType) for f in out.schema] != [(f.name, f.dataType) for f in spec.schema()]:
        raise ValueError("conformed rows do not have the declared schema")
    return V.rounded(out)


S02 = f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS symbol,
       CAST(l_shipdate AS DATE) AS date, CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high,
       CAST(NULL AS DOUBLE) AS low, {O.r6("l_extendedprice")} AS close,
       CAST(NULL AS DOUBLE) AS adj_close, CAST(l_quantity / 4 AS BIGINT) AS volume,
       CAST(NULL AS DOUBLE) AS vwap, CAST(NULL AS DOUBLE) AS change,
       {O.r6("l_discount")} AS change_pct
FROM lineitem"""


def s03_latest_scan(spark, sf_dir):
    columns = ["securities_transacted", "insider_price", "acquisition_or_disposition"]
    return V.source(spark, sf_dir).read("insider_trades", None, "2024-01-05", "2024-01-20", columns)


S03 = """
SELECT symbol, date, securities_transacted, insider_price, acquisition_or_disposition
FROM insider_trades WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""


def s02_bucketed_layout(spark, sf_dir):
    """Prices of a year are corrected after a publication: that year is published anew, then read with statements."""
    folder = shared_folder(spark, "bucketed")
    given = V.source(spark, sf_dir)
    days = given.scan("daily_price")
    wrong = F.when(F.year("date") == 1997, F.col("close") * 2).otherwise(F.col("close"))
    store = VersionedStore(spark, f"{folder}/store")
    store.append_conformed("daily_price", days.withColumn("close", wrong), "2024-01-01 00:00:00", 1)
    published = BucketedStore(spark, f"{folder}/published", buckets=8)
    published.publish("daily_price", store)
    published.publish("income_statement", given)
    store.append_conformed("daily_price", days.filter(F.year("date") == 1997), "2024-02-01 00:00:00", 2)
    if (again := published.refresh("daily_price", store, "2024-01-01 00:00:00")) != [1997]:
        raise ValueError(f"published anew: {again}")
    q = PanelQuery(published, V.registry()).all_symbols().select("close", "revenue", "return_1d")
    return V.rounded(q.execute())


S02_BUCKETED = f"""
SELECT symbol, date, {O.r6("close")} AS close, revenue,
       {O.r6("close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1")} AS return_1d
FROM (SELECT s.symbol, s.date, close, revenue
      FROM daily s ASOF LEFT JOIN quarterly q ON s.symbol = q.symbol AND s.date >= q.date)"""


def s04_source_names(spark, sf_dir):
    rows = V.source(spark, sf_dir).read_source_names("insider_trades")
    return rows.select(
        "symbol", "date", "reportingName", "typeOfOwner", "acquisitionOrDisposition",
        "securitiesTransacted", "price", "formType",
    )


S04 = """
SELECT symbol, date, reporting_name AS reportingName, type_of_owner AS typeOfOwner,
       acquisition_or_disposition AS acquisitionOrDisposition,
       securities_transacted AS securitiesTransacted, insider_price AS price,
       CAST(NULL AS VARCHAR) AS formType
FROM insider_trades"""


CELLS = TableSpec("cells", Grain.SNAPSHOT, ("symbol",), {f.name: f for f in (
    FieldSpec("as_text", "text", "string"), FieldSpec("as_double", "number", "double"), FieldSpec("as_bigint", "whole", "bigint"))})


def s05_csv_cleanup(spark, sf_dir):
    """CSV files whose cells hold every null token, read into the table's types."""
    k = F.col("event_id") % 8
    text = (
        F.when(k == 0, "").when(k == 1, "None").when(k == 2, "NaN").when(k == 3, "Infinity")
        .when(k == 4, "inf").when(k == 5, F.concat(F.lit(" "), F.col("value").cast("string")))
        .when(k == 6, F.col("user_id").cast("string")).otherwise(F.col("event_type"))
    )
    folder = f"{shared_folder(spark, 'csv')}/cells"
    cells = V.events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("symbol"), text.alias("text"), text.alias("number"), text.alias("whole"))
    cells.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(folder)
    return L.read_csv(spark, folder, CELLS).select(
        F.col("symbol").cast("bigint").alias("event_id"), F.col("text").alias("as_text"),
        V.r6("number").alias("as_double"), F.col("whole").alias("as_bigint"))


S05 = f"""
SELECT event_id, cell AS as_text, {O.r6("TRY_CAST(cell AS DOUBLE)")} AS as_double,
       CAST(TRY_CAST(cell AS DOUBLE) AS BIGINT) AS as_bigint
FROM (SELECT event_id, CASE event_id % 8 WHEN 5 THEN CAST(value AS VARCHAR)
             WHEN 6 THEN CAST(user_id AS VARCHAR) WHEN 7 THEN event_type END AS cell FROM ev)"""


def _responses(spark, sf_dir):
    """Raw responses: one JSON object, or a list of two, per event."""
    one = F.to_json(F.struct(F.col("symbol"), F.col("value").alias("price"),
                             F.col("user_id").alias("volume"), F.col("event_type").alias("other")))
    two = F.concat(F.lit(" ["), one, F.lit(","), one, F.lit("]"))
    return V.events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 2 == 0, one).otherwise(two).alias("body")
    )


def s06_x16_json_payloads(spark, sf_dir):
    rows = L.parse_payload(_responses(spark, sf_dir), "body", CATALOG["quote"])
    return rows.select("event_id", "symbol", "price", "volume", "dayHigh")


S06 = """
SELECT event_id, symbol, value AS price, user_id AS volume, CAST(NULL AS DOUBLE) AS dayHigh FROM ev
UNION ALL
SELECT event_id, symbol, value, user_id, NULL FROM ev WHERE event_id % 2 = 1"""


def s07_default_symbol(spark, sf_dir):
    rows = V.events(spark, sf_dir).select(
        F.when(F.col("event_type") != "view", F.col("symbol")).alias("symbol"),
        F.concat(F.lit("asked-"), "symbol").alias("_requested_symbol"), "event_id",
    )
    return L.stamp_symbol(rows).select("event_id", "symbol")


S07 = """
SELECT event_id, CASE WHEN event_type <> 'view' THEN symbol ELSE 'asked-' || symbol END AS symbol
FROM ev"""


def s08_unexpired_responses(spark, sf_dir):
    raw = V.events(spark, sf_dir).select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("fetched_at"),
        (F.col("event_id") % 4 * 86400).cast("int").alias("ttl_seconds"), "props", "event_id",
        L.response_key(F.col("event_type"), F.create_map(F.lit("user"), F.col("symbol"))).alias(
            "cache_key"
        ),
    )
    live = L.unexpired(raw, "2024-01-31 00:00:00")
    return live.select("user_id", "event_type", "event_id", "props")


S08 = """
SELECT user_id, event_type, event_id, props
FROM (SELECT * FROM ev
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
WHERE ts + to_seconds(event_id % 4 * 86400) > TIMESTAMP '2024-01-31 00:00:00'"""


def s09_adhoc_sql(spark, sf_dir):
    V.source(spark, sf_dir).create_views(spark, ["daily_price", "income_statement"])
    return V.rounded(spark.sql(
        """
        SELECT p.symbol, p.days, p.volume, s.quarters, s.revenue, p.top
        FROM (SELECT symbol, count(*) AS days, sum(volume) AS volume, max(high) AS top
              FROM daily_price WHERE date >= :since GROUP BY symbol) p
        JOIN (SELECT symbol, count(*) AS quarters, sum(revenue) AS revenue
              FROM income_statement GROUP BY symbol) s USING (symbol)
        """,
        args={"since": "1996-01-01"},
    ))


S09 = f"""
SELECT p.symbol, days, volume, quarters, revenue, {O.r6("top")} AS top
FROM (SELECT symbol, count(*) AS days, CAST(sum(volume) AS BIGINT) AS volume, max(high) AS top
      FROM daily WHERE date >= DATE '1996-01-01' GROUP BY 1) p
JOIN (SELECT symbol, count(*) AS quarters, CAST(sum(revenue) AS BIGINT) AS revenue
      FROM quarterly GROUP BY 1) s USING (symbol)"""

QUERIES = {
    "s01_typed_append": (s01_typed_append, O.sql(S01)),
    "s02_typed_table": (s02_typed_table, O.sql(S02)),
    "s02_s03_bucketed_layout": (s02_bucketed_layout, O.sql(S02_BUCKETED)),
    "s03_latest_scan": (s03_latest_scan, O.sql(S03)),
    "s04_source_names": (s04_source_names, O.sql(S04)),
    "s05_csv_cleanup": (s05_csv_cleanup, O.sql(S05)),
    "s06_x16_json_payloads": (s06_x16_json_payloads, O.sql(S06)),
    "s07_default_symbol": (s07_default_symbol, O.sql(S07)),
    "s08_unexpired_responses": (s08_unexpired_responses, O.sql(S08)),
    "s09_adhoc_sql": (s09_adhoc_sql, O.sql(S09)),
}
