"""V01–V12 and O03 over the bitemporal event rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain import VersionedStore, default_catalog
from panelgrain.operators import versions as VO
from panelgrain.plans.session import shared_folder

from .. import oracle as O
from .. import views as V
from .streams import EVENT_TABLE

KEYS = ["symbol", "date"]
NOW = "2024-01-31 00:00:00"


def _out(df):
    return V.rounded(df.select("symbol", "date", "value", F.col("_seq").alias("seq")))


def v01_latest_per_key(spark, sf_dir):
    return _out(VO.latest(V.event_versions(spark, sf_dir), KEYS))


def _newest(where="TRUE", n=1):
    return f"""
SELECT symbol, date, {O.r6("value")} AS value, seq FROM event_versions WHERE {where}
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY fetched_at DESC, seq DESC) <= {n}"""


def v02_as_of_version(spark, sf_dir):
    return _out(VO.as_of_version(V.event_versions(spark, sf_dir), KEYS, "2024-01-15 12:00:00"))


def v03_revisions(spark, sf_dir):
    """All versions of every key with more than one, with their position in load order."""
    df = VO.revisions(V.event_versions(spark, sf_dir))
    counts = VO.revision_counts(V.event_versions(spark, sf_dir), KEYS).filter("versions > 1")
    return V.rounded(df.join(counts, KEYS).select("symbol", "date", "value", "versions"))


V03 = f"""
SELECT symbol, date, {O.r6("value")} AS value, versions
FROM event_versions JOIN (SELECT symbol, date, count(*) AS versions FROM event_versions GROUP BY 1, 2)
     USING (symbol, date)
WHERE versions > 1"""


def v04_o03_keep_newest_two(spark, sf_dir):
    return _out(VO.keep_newest(V.event_versions(spark, sf_dir), KEYS, 2))


def v04_compact(spark, sf_dir):
    """Two loads appended to a stored table, compacted to two versions a key, and read."""
    folder = shared_folder(spark, "compact")
    store = VersionedStore(spark, f"{folder}/store", default_catalog().add(EVENT_TABLE))
    rows = V.event_versions(spark, sf_dir).withColumnRenamed("value", "event_value").withColumns(
        {"event_kind": F.lit("any"), "event_number": F.col("_seq")})
    for odd in (1, 0):
        store.append_conformed("user_events", rows.filter(F.col("_seq") % 2 == odd))
    store.compact("user_events", keep=2)
    return _out(store.frame("user_events").withColumnRenamed("event_value", "value"))


def v04_compaction_report(spark, sf_dir):
    return VO.compaction_report(V.event_versions(spark, sf_dir), KEYS, 1)


V04R = """
SELECT CAST(sum(least(n, 1)) AS BIGINT) AS kept_rows,
       CAST(sum(n) - sum(least(n, 1)) AS BIGINT) AS deleted_rows
FROM (SELECT count(*) AS n FROM event_versions GROUP BY symbol, date)"""


def v05_row_count(spark, sf_dir):
    return VO.row_count(V.event_versions(spark, sf_dir))


def v06_freshness(spark, sf_dir):
    out = VO.freshness(V.event_versions(spark, sf_dir), 86_400, NOW)
    return out.select("symbol", F.to_date("last_fetched_at").alias("last_day"), "is_fresh")


V06 = f"""
SELECT symbol, CAST(max(fetched_at) AS DATE) AS last_day,
       max(fetched_at) + INTERVAL 86400 SECOND > TIMESTAMP '{NOW}' AS is_fresh
FROM event_versions GROUP BY symbol"""


def v07_coverage(spark, sf_dir):
    return VO.coverage(V.event_versions(spark, sf_dir), "2024-01-10", "2024-01-20")


V07 = """
SELECT symbol, min(date) AS first_date, max(date) AS last_date, count(*) AS row_count
FROM event_versions WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1"""


def v07_gaps(spark, sf_dir):
    """Stretches of event days on which a user has none, as ranges to fetch; customers without events lack them all."""
    events = V.events(spark, sf_dir)
    asked = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))
    return VO.coverage_gaps(events, events.select("date"), asked)


V07_GAPS = """
WITH days AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM ev)),
wanted AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS symbol FROM customer),
lacking AS (SELECT symbol, date, n FROM wanted CROSS JOIN days ANTI JOIN ev USING (symbol, date))
SELECT symbol, min(date) AS from_date, max(date) AS to_date, count(*) AS missing_days
FROM (SELECT *, n - row_number() OVER (PARTITION BY symbol ORDER BY n) AS island FROM lacking)
GROUP BY symbol, island"""


def v08_years_covered(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return VO.years_covered(lines)


V08 = "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem"


def v09_symbols_with_data(spark, sf_dir):
    return VO.symbols_with_data(V.event_versions(spark, sf_dir))


def v10_missing_work(spark, sf_dir):
    """Brand × quarter cells without a single large sale."""
    lines = V.lines(spark, sf_dir)
    wanted = VO.period_grid(lines, "symbol", "1995-01-01", "2001-12-31", "quarter")
    large = lines.filter(F.col("l_quantity") >= 49).select(
        "symbol", F.trunc("date", "quarter").alias("period_start")
    )
    return VO.missing_work(wanted, large, ["symbol", "period_start"])


V10 = """
SELECT symbol, period_start
FROM (SELECT DISTINCT symbol FROM lines) CROSS JOIN
     (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-10-01', INTERVAL 3 MONTH))
             AS DATE) AS period_start)
EXCEPT
SELECT symbol, CAST(date_trunc('quarter', date) AS DATE) FROM lines WHERE l_quantity >= 49"""


def v11_universe(spark, sf_dir):
    """Customers as listed companies."""
    key = F.col("c_custkey")
    suffix = F.when(key % 9 == 0, ".B").when(key % 9 == 1, "-A").otherwise("")
    codes = F.array(*[F.lit(c) for c in ("NYSE", "NASDAQ", "AMEX", "LSE", "PAR")])
    profiles = V.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), key, suffix).alias("symbol"),
        F.element_at(codes, (F.col("c_nationkey") % 5 + 1).cast("int")).alias("exchange_short"),
        F.when(key % 4 != 0, F.col("c_acctbal") > 0).alias("is_actively_trading"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_etf"),
        F.when(key % 7 == 0, key % 2 == 0).alias("is_fund"),
    )
    return VO.select_universe(profiles, ["us", "GB"])


V11 = """
SELECT symbol
FROM (SELECT 'C' || c_custkey || CASE c_custkey % 9 WHEN 0 THEN '.B' WHEN 1 THEN '-A' ELSE '' END
                 AS symbol,
             ['NYSE', 'NASDAQ', 'AMEX', 'LSE', 'PAR'][c_nationkey % 5 + 1] AS exchange, *
      FROM customer)
WHERE exchange IN ('NYSE', 'NASDAQ', 'AMEX', 'LSE')
  AND (c_custkey % 4 = 0 OR c_acctbal > 0) AND c_mktsegment <> 'BUILDING'
  AND NOT (c_custkey % 7 = 0 AND c_custkey % 2 = 0)
  AND NOT (exchange <> 'LSE' AND c_custkey % 9 < 2)"""


def v12_index_universe(spark, sf_dir):
    return VO.index_universe(V.daily(spark, sf_dir), V.members(spark, sf_dir)).select(
        "symbol", "date", "volume"
    )


V12 = "SELECT symbol, date, volume FROM daily WHERE symbol IN (SELECT symbol FROM members)"

QUERIES = {
    "v01_latest_per_key": (v01_latest_per_key, O.sql(_newest())),
    "v02_as_of_version": (
        v02_as_of_version, O.sql(_newest("fetched_at <= TIMESTAMP '2024-01-15 12:00:00'"))),
    "v03_revisions": (v03_revisions, O.sql(V03)),
    "v04_o03_keep_newest_two": (v04_o03_keep_newest_two, O.sql(_newest(n=2))),
    "v04_compact_store": (v04_compact, O.sql(_newest(n=2))),
    "v04_compaction_report": (v04_compaction_report, O.sql(V04R)),
    "v05_row_count": (v05_row_count, O.sql("SELECT count(*) AS row_count FROM event_versions")),
    "v06_o02_freshness": (v06_freshness, O.sql(V06)),
    "v07_o02_coverage": (v07_coverage, O.sql(V07)),
    "v07_v10_coverage_gaps": (v07_gaps, O.sql(V07_GAPS)),
    "v08_x12_years_covered": (v08_years_covered, O.sql(V08)),
    "v09_symbols_with_data": (
        v09_symbols_with_data, O.sql("SELECT DISTINCT symbol FROM event_versions")),
    "v10_missing_work": (v10_missing_work, O.sql(V10)),
    "v11_universe": (v11_universe, O.sql(V11)),
    "v12_index_universe": (v12_index_universe, O.sql(V12)),
}
