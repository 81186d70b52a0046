"""Catalogue tables derived from the supplied TPC-H-like tables, for Spark.

``workload/oracle.py`` holds the same definitions as SQL.  Nothing is cached: a
query's work starts at the parquet scan.  Tables of one grain share one wide
frame, so a query that touches several of them scans and aggregates once.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain import FrameSource, PanelQuery
from panelgrain.functions.features import default_registry

AS_OF = "2002-01-01"
EVENTS_AS_OF = "2024-01-30"
REGISTRY: list = []

QUARTERLY = (
    "income_statement", "balance_sheet", "cash_flow", "key_metrics", "dividends_data",
    "earnings_data", "analyst_estimates", "splits_data", "historical_institutional",
)
SNAPSHOT = (
    "quote", "profile", "price_target", "grades_consensus", "ratings", "shares_float_data",
    "dcf_data", "esg_data", "price_change", "institutional_summary",
)


def registry():
    if not REGISTRY:
        REGISTRY.append(default_registry())
    return REGISTRY[0]


SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its schema is read from the footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def r6(value: Column | str) -> Column:
    """Six decimals by the same double arithmetic as the SQL side.

    Rounding is nudged upwards by 0.01 of the last place so that exact ties do not
    depend on the last bit of a mean.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * F.lit(1e6) + F.lit(0.51)) / F.lit(1e6)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[r6(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def decimal(value: Column, scale: int = 4) -> Column:
    return value.cast(f"decimal(18,{scale})")


def exact_sum(value: Column, scale: int = 4) -> Column:
    """Order-independent sum: whole units of 10^-scale are summed as BIGINT.

    Several times cheaper than casting every double to DECIMAL, and the buffer is a
    long.  ANSI mode raises if a sum should ever leave the BIGINT range.
    """
    units = F.floor(value * F.lit(float(10**scale)) + F.lit(0.5))
    one = "0." + "0" * (scale - 1) + "1"
    return F.sum(units).cast("decimal(28,0)") * F.lit(one).cast(f"decimal({scale + 1},{scale})")


def part_of(share: str, amount: str) -> str:
    """SQL text: an exact decimal share of an aggregated amount, as whole units."""
    return f"CAST(round(CAST({share} AS DECIMAL(6,2)) * {amount}, 0) AS BIGINT)"


# -- line level ----------------------------------------------------------------
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades of a brand: price in whole cents per unit."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("date"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100.0).alias("px"),
    )
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumnRenamed("p_brand", "symbol")


def line_order() -> Column:
    """The full line key as one DECIMAL(38,0): order, line, part, supplier.

    A decimal can be updated in place, so min_by/max_by stay in a hash aggregate; a
    struct key would make Spark sort every line first (1.7 times slower measured).
    Too large a key raises under ANSI mode rather than wrapping.
    """
    def digits(value: Column, n: int) -> Column:
        return value.cast(f"decimal({n},0)")

    major = digits(F.col("l_orderkey") * 16 + F.col("l_linenumber"), 16)
    minor = digits(F.col("l_partkey"), 11) * F.lit("1" + "0" * 10).cast("decimal(11,0)") + digits(
        F.col("l_suppkey"), 10
    )
    return major * F.lit("1" + "0" * 21).cast("decimal(22,0)") + minor


# -- daily -----------------------------------------------------------------
def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """daily_price and historical_market_cap."""
    bars = lines(spark, sf_dir).groupBy("symbol", "date").agg(
        F.min_by("px", line_order()).alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", line_order()).alias("close"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
        exact_sum(F.col("l_extendedprice"), 2).alias("__turnover"),
    )
    return bars.select(
        "symbol", "date", "open", "high", "low", "close", F.col("close").alias("adj_close"),
        "volume",
        (F.col("__turnover").cast("double") / F.col("volume")).alias("vwap"),
        (F.col("close") - F.col("open")).alias("change"),
        ((F.col("close") - F.col("open")) / F.col("open") * 100).alias("change_pct"),
        F.floor(F.col("close") * 1_000_000 + 0.5).alias("hist_market_cap"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """treasury_rates: one row per ship date."""
    per_day = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_shipdate").cast("date").alias("date")
    ).agg(
        exact_sum(F.col("l_tax")).alias("t"),
        exact_sum(F.col("l_discount")).alias("d"),
        F.count(F.lit(1)).alias("n"),
    )
    tax, disc = (100 * F.col(c).cast("double") / F.col("n") for c in ("t", "d"))
    return per_day.select(
        "date", tax.alias("rate_3m"), disc.alias("rate_2y"), (tax + disc).alias("rate_10y"),
        (tax + disc + 1).alias("rate_30y"),
    )


# -- quarterly -----------------------------------------------------------------
def quarter_end(date: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(date, "quarter"), 3), 1)


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements and every other quarterly table."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    sums = lines(spark, sf_dir).groupBy("symbol", quarter_end(F.col("date")).alias("date")).agg(
        exact_sum(net).alias("r"),
        exact_sum(F.col("p_retailprice") * F.col("l_quantity")).alias("p"),
        exact_sum(net * F.col("l_tax"), 6).alias("t"),
        exact_sum(F.col("l_extendedprice") * F.col("l_discount")).alias("d"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.count(F.lit(1)).alias("n"),
    )
    # One projection; later columns refer to earlier ones by name.
    shares = {
        "revenue": ("1", "r"), "cost_of_revenue": ("0.5", "p"), "sga_expenses": ("0.1", "r"),
        "rd_expenses": ("0.05", "p"), "interest_expense": ("0.2", "d"),
        "interest_income": ("0.05", "d"), "income_tax_expense": ("1", "t"),
        "depreciation_and_amortization": ("0.03", "p"), "cash_and_equivalents": ("0.1", "r"),
        "short_term_investments": ("0.05", "r"), "net_receivables": ("0.15", "r"),
        "inventory": ("0.2", "p"), "other_current_assets": ("0.03", "p"),
        "property_plant_equipment": ("0.8", "p"), "goodwill": ("0.05", "p"),
        "goodwill_and_intangibles": ("0.08", "p"), "accounts_payable": ("0.12", "p"),
        "total_current_liabilities": ("0.3", "p"), "long_term_debt": ("0.3", "r"),
        "total_debt": ("0.4", "r"), "retained_earnings": ("0.3", "r"),
        "deferred_revenue": ("0.02", "r"), "capex": ("-0.04", "p"), "dividends_paid": ("-0.1", "r"),
        "share_repurchase": ("-0.1", "d"), "debt_repayment": ("0.1", "d"), "market_cap": ("12", "r"),
        "revenue_estimated": ("0.9", "p"), "est_revenue_avg": ("1.05", "r"),
        "hist_inst_invested": ("1", "p"), "hist_inst_invested_change": ("0.1", "d"),
    }
    derived = {
        "total_current_assets":
            "CAST(round(CAST(0.5 AS DECIMAL(6,2)) * r + CAST(0.2 AS DECIMAL(6,2)) * p, 0) AS BIGINT)",
        "total_assets": "CAST(round(CAST(2 AS DECIMAL(6,2)) * r + p, 0) AS BIGINT)",
        "total_liabilities":
            "CAST(round(CAST(0.4 AS DECIMAL(6,2)) * r + CAST(0.5 AS DECIMAL(6,2)) * p, 0) AS BIGINT)",
        "weighted_avg_shares_diluted": "1000 * q",
        "weighted_avg_shares": "990 * q",
        "num_analysts_eps": "CAST(n % 20 AS INT)",
        "split_numerator": "CAST(2 + q % 3 AS INT)",
        "split_denominator": "CAST(1 + q % 2 AS INT)",
        "hist_inst_holders": "CAST(n AS INT)",
        "hist_inst_holders_change": "CAST(n % 7 - 3 AS INT)",
        "gross_profit": "revenue - cost_of_revenue",
        "operating_expenses": "sga_expenses + rd_expenses",
        "total_stockholders_equity": "total_assets - total_liabilities",
        "enterprise_value": "market_cap + total_debt - cash_and_equivalents",
        "earnings_revenue": "revenue",
        "adj_dividend": "-dividends_paid / weighted_avg_shares_diluted",
        "operating_income": "gross_profit - operating_expenses",
        "income_before_tax": "operating_income - interest_expense",
        "ebitda": "operating_income + depreciation_and_amortization",
        "net_income": "income_before_tax - income_tax_expense",
        "eps_diluted": "net_income / weighted_avg_shares_diluted",
        "earnings_eps": "eps_diluted",
        "eps_estimated": "operating_income * 0.8D / weighted_avg_shares_diluted",
        "est_eps_avg": "income_before_tax * 1.1D / weighted_avg_shares_diluted",
        "operating_cash_flow": "net_income + depreciation_and_amortization",
        "free_cash_flow": "operating_cash_flow + capex",
    }
    return sums.selectExpr(
        "symbol", "date", "concat('Q', quarter(date)) AS period",
        *[f"{part_of(*v)} AS {k}" for k, v in shares.items()],
        *[f"{v} AS {k}" for k, v in derived.items()],
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """historical_grades: recommendation counts per month end."""
    return lines(spark, sf_dir).groupBy("symbol", F.last_day("date").alias("date")).agg(
        *[F.count_if(F.col("l_returnflag") == v).cast("int").alias(n)
          for v, n in (("A", "hist_strong_buy"), ("N", "hist_buy"), ("R", "hist_hold"))],
        *[F.count_if(F.col("l_linestatus") == v).cast("int").alias(n)
          for v, n in (("F", "hist_sell"), ("O", "hist_strong_sell"))],
    )


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """employee_count per year end."""
    year_end = F.make_date(F.year("date"), F.lit(12), F.lit(31))
    return lines(spark, sf_dir).groupBy("symbol", year_end.alias("date")).agg(
        F.count(F.lit(1)).cast("int").alias("employee_count_val")
    )


# -- snapshots ---------------------------------------------------------------
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote, profile and the other per-symbol tables."""
    c = F.col
    grades = {"strong_buy": c("l_returnflag") == "A", "buy": c("l_returnflag") == "N",
              "hold": c("l_returnflag") == "R", "sell": c("l_linestatus") == "F",
              "strong_sell": c("l_linestatus") == "O"}
    # Days first, symbols second: the heavy step is spread over (symbol, day).
    days = lines(spark, sf_dir).groupBy("symbol", "date").agg(
        F.max_by("px", line_order()).alias("px_last"),
        F.max("px").alias("px_high"),
        F.min("px").alias("px_low"),
        F.sum(c("l_quantity").cast("bigint")).alias("q"),
        F.count(F.lit(1)).alias("n"),
        exact_sum(c("l_extendedprice") * (1 - c("l_discount"))).alias("r"),
        F.sum("p_size").alias("sizes"),
        F.max("p_size").alias("size_max"),
        F.min("p_size").alias("size_min"),
        *[F.count_if(cond).alias(k) for k, cond in grades.items()],
    )
    agg = days.groupBy("symbol").agg(
        F.max_by("px_last", "date").alias("price"),
        F.max("px_high").alias("year_high"),
        F.min("px_low").alias("year_low"),
        F.sum("q").alias("q"),
        F.sum("n").alias("n"),
        F.sum("r").alias("r"),
        F.min("date").alias("ipo_date"),
        F.sum("sizes").alias("sizes"),
        F.max("size_max").cast("double").alias("esg_social"),
        F.min("size_min").cast("double").alias("esg_governance"),
        *[F.sum(k).cast("int").alias(k) for k in grades],
    )
    # Text extremes cannot be updated in place; taking them from the small table keeps
    # the line aggregation in a hash table.
    types = table(spark, sf_dir, "part").groupBy(c("p_brand").alias("symbol")).agg(
        F.min("p_type").alias("sector"), F.max("p_type").alias("industry")
    )
    agg = agg.join(types, "symbol", "left")
    spans = ("1d", "5d", "1m", "3m", "6m", "ytd", "1y", "3y", "5y")
    return agg.selectExpr(
        "symbol", "price", "year_high", "year_low", "ipo_date", "sector", "industry",
        "CAST(regexp_extract(symbol, '([0-9]+)$', 1) AS INT) AS brand",
        "CAST(round(r, 0) AS BIGINT) AS quote_market_cap",
        "quote_market_cap AS profile_market_cap",
        "floor(q / n) AS quote_volume",
        "element_at(array('NYSE', 'NASDAQ', 'LSE', 'AMEX'), brand % 4 + 1) AS exchange_short",
        "CASE WHEN brand % 4 = 2 THEN 'GB' ELSE 'US' END AS country",
        "brand % 7 = 0 AS is_etf",
        "brand % 11 = 0 AS is_fund",
        "brand % 5 <> 0 AS is_actively_trading",
        "(brand % 30 + 5) / 10.0D AS beta",
        "year_high * 1.1D AS target_high",
        "year_low * 0.9D AS target_low",
        "price * 1.2D AS target_consensus",
        "price * 1.1D AS target_median",
        *grades,
        "brand % 5 + 1 AS provider_rating_score",
        "800 * q AS float_shares",
        "1000 * q AS outstanding_shares",
        "price * 1.05D AS dcf_val",
        "sizes / n AS esg_environmental",
        "esg_social", "esg_governance",
        "sizes / n + esg_social AS esg_score",
        *[f"price / year_low - {i + 1} / 10.0D AS provider_return_{s}" for i, s in enumerate(spans)],
        "CAST(n AS INT) AS inst_holders_count",
        "CAST(n - 3 AS INT) AS inst_holders_prev",
        "3 AS inst_holders_change",
        "quote_market_cap AS inst_total_invested",
        "quote_market_cap - 1000 * n AS inst_invested_prev",
        "1000 * n AS inst_invested_change",
        "q / n AS inst_put_call_ratio",
    ).drop("brand")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index constituents: brands traded more often than the average brand."""
    per_brand = lines(spark, sf_dir).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    mean = per_brand.agg(F.avg("n")).scalar()
    return per_brand.filter(F.col("n") > mean).select("symbol")


def index_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference index: mean close per date, in whole cents."""
    per_day = daily(spark, sf_dir).groupBy("date").agg(
        F.sum(decimal(F.col("close"), 2)).alias("s"), F.count(F.lit(1)).alias("n")
    )
    return per_day.select(
        "date",
        (F.floor(F.col("s").cast("double") / F.col("n") * 100 + 0.5) / 100.0).alias("close"),
    )


# -- events --------------------------------------------------------------------
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("symbol", F.col("user_id").cast("string")).withColumn(
        "date", F.col("ts").cast("date")
    )


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitemporal rows: the day's events of a user are versions of one row."""
    return events(spark, sf_dir).select(
        "symbol", "date", "value", F.col("ts").cast("timestamp").alias("_fetched_at"),
        F.col("event_id").alias("_seq"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insider trades, one row per event."""
    side = (
        F.when(F.col("event_type") == "purchase", "A").when(F.col("event_type") == "click", "D")
        .otherwise("-")
    )
    shares = F.from_json("props", "k bigint")["k"]
    return events(spark, sf_dir).select(
        "symbol", "date",
        side.alias("acquisition_or_disposition"),
        shares.alias("securities_transacted"),
        F.col("value").alias("insider_price"),
        (F.col("event_id") % 7).cast("string").alias("reporting_name"),
        F.when(F.col("event_id") % 3 == 0, "Officer: vice president").otherwise("director holder").alias(
            "type_of_owner"
        ),
        F.col("ts").cast("timestamp").alias("_fetched_at"),
        F.col("event_id").alias("_seq"),
    )


def insider_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = F.when(F.col("event_id") % 3 == 0, "Officer").otherwise("holder")
    base = trades(spark, sf_dir).withColumn("event_id", F.col("_seq"))
    return base.withColumn("type_of_owner", owner).drop("_fetched_at", "_seq", "event_id")


def senate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        F.when(F.col("event_type") == "purchase", "Purchase")
        .when(F.col("event_type") == "click", "Sale (Full)").otherwise("Exchange")
    )
    return events(spark, sf_dir).select("symbol", "date", kind.alias("type"))


def grade_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = (
        F.when(F.col("event_type") == "signup", "Upgrade")
        .when(F.col("event_type") == "error", "downgrade").otherwise("hold")
    )
    return events(spark, sf_dir).select("symbol", "date", action.alias("action"))


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes of the event symbols: the spine of the event queries."""
    return events(spark, sf_dir).groupBy("symbol", "date").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("close")
    )


# -- sources -------------------------------------------------------------------
def source(spark: SparkSession, sf_dir: str) -> FrameSource:
    """Every catalogue table the supplied data can stand in for."""
    day, quarter, snap, month, year, rate, trade = (
        partial(f, spark, sf_dir)
        for f in (daily, quarterly, snapshot, monthly, annual, rates, trades)
    )
    frames = {"daily_price": day, "historical_market_cap": day}
    frames.update({t: quarter for t in QUARTERLY})
    frames.update({t: snap for t in SNAPSHOT})
    frames.update(
        historical_grades=month, employee_count=year, treasury_rates=rate, insider_trades=trade
    )
    return FrameSource(frames)


def query(spark: SparkSession, sf_dir: str) -> PanelQuery:
    return PanelQuery(source(spark, sf_dir), registry()).all_symbols()
