"""W01–W11 over daily prices and X01–X17: window and scalar functions, one query each.

The window queries register their columns as custom features, as a user would (U01).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain.functions import expr as E
from panelgrain.functions.registry import FeatureRegistry
from panelgrain.operators import recursive as R

from .. import oracle as O
from .. import views as V

W = "PARTITION BY symbol ORDER BY date"


def _over(n):
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _custom(builders):
    """A query of user-registered features over daily prices."""
    def run(spark, sf_dir):
        registry = FeatureRegistry()
        registry.add_all("custom", builders)
        q = V.PanelQuery(V.source(spark, sf_dir), registry).all_symbols()
        return V.rounded(q.select(list(builders)).execute())
    return run


def _sql(columns, source="daily"):
    body = ",\n       ".join(f"{O.r6(e) if r else e} AS {n}" for n, (e, r) in columns.items())
    return O.sql(f"SELECT symbol, date, {body}\nFROM {source}")


def _rolls(how, lengths, column="close"):
    return {f"{how}_{n}": (lambda n: lambda p: p.roll(how, column, n))(n) for n in lengths}


def _roll_sql(name, call, lengths):
    return _sql({f"{name}_{n}": (f"{call} {_over(n)}", True) for n in lengths})


STEPS = (1, 3, 5, 10, 21, 42, 63, 126, 252)
RETURNS = ("(SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 "
           "AS ret FROM daily)")


def _of_returns(how, n):
    def build(p):
        step = p.define("step", E.ratio(p["close"], p.lag("close")) - 1)
        return p.roll(how, step, n)
    return build


def w10_rolling_correlation(spark, sf_dir):
    from panelgrain.operators.market import with_autocorrelation

    daily = V.daily(spark, sf_dir).select("symbol", "date", "close")
    return V.rounded(with_autocorrelation(daily, "corr_60", rows=60, least=30).drop("close"))


W10 = f"""
SELECT symbol, date, {O.r6("CASE WHEN n >= 30 THEN c END")} AS corr_60
FROM (SELECT symbol, date, corr(ret, prev) {_over(60)} AS c,
             count(CASE WHEN ret IS NOT NULL AND prev IS NOT NULL THEN 1 END) {_over(60)} AS n
      FROM (SELECT *, lag(ret) OVER ({W}) AS prev FROM {RETURNS}))"""


def w11_row_number(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("symbol").orderBy("date")
    return V.daily(spark, sf_dir).select("symbol", "date", F.row_number().over(w).alias("n"))


W11 = f"SELECT symbol, date, CAST(row_number() OVER ({W}) AS INTEGER) AS n FROM daily"


# -- scalar functions -------------------------------------------------------------
def _lines(*columns):
    def run(spark, sf_dir):
        lines = V.lines(spark, sf_dir)
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        return V.rounded(lines.select(*keys, *[c(F.col).alias(n) for n, c in columns]))
    return run


def _lines_sql(**columns):
    body = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return O.sql(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {body} FROM lines")


def _events(*columns):
    def run(spark, sf_dir):
        ev = V.events(spark, sf_dir)
        return V.rounded(ev.select("event_id", *[c(F.col).alias(n) for n, c in columns]))
    return run


def _events_sql(**columns):
    body = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return O.sql(f"SELECT event_id, {body} FROM ev")




def w12_long_series(spark, sf_dir):
    """A running mean over every single event of a kind: few series, each over many tasks."""
    ticks = V.events(spark, sf_dir).select(F.col("event_type").alias("symbol"), "ts", "event_id", "value")
    return V.rounded(R.long_ema(ticks, 10, "value", ["ts", "event_id"]).select("symbol", "event_id", "value", "ema"))


# 400 rows back a weight of (9/11)^k is below 1e-34 of the newest one.
W12_LONG = f"""
SELECT symbol, event_id, {O.r6("value")} AS value,
       {O.r6("list_sum([back[k] * pow(9.0::DOUBLE / 11, len(back) - k) for k in range(1, len(back) + 1)]) / list_sum([pow(9.0::DOUBLE / 11, len(back) - k) for k in range(1, len(back) + 1)])")} AS ema
FROM (SELECT event_type AS symbol, event_id, value, list(value) OVER (
          PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS back
      FROM events)"""

QUERIES = {
    "w12_long_series": (w12_long_series, O.sql(W12_LONG)),
    "w01_lag": (
        _custom({f"ago_{k}": (lambda k: lambda p: p.lag("close", k))(k) for k in STEPS}),
        _sql({f"ago_{k}": (f"lag(close, {k}) OVER ({W})", True) for k in STEPS}),
    ),
    "w02_rolling_avg": (_custom(_rolls("avg", (14, 20, 50, 200))),
                        _roll_sql("avg", "avg(close)", (14, 20, 50, 200))),
    "w03_rolling_stddev": (_custom(_rolls("stddev", (5, 20, 60, 252))),
                           _roll_sql("stddev", "stddev_samp(close)", (5, 20, 60, 252))),
    "w04_rolling_max_min": (
        _custom({**_rolls("max", (20, 252)), **_rolls("min", (20, 252))}),
        _sql({f"{f}_{n}": (f"{f}(close) {_over(n)}", True) for f in ("max", "min") for n in (20, 252)}),
    ),
    "w05_rolling_sum": (
        _custom(_rolls("sum", (4, 20, 252), "volume")),
        _sql({f"sum_{n}": (f"CAST(sum(volume) {_over(n)} AS BIGINT)", False) for n in (4, 20, 252)}),
    ),
    "w06_running_sum": (
        _custom({"running": lambda p: p.roll("sum", "volume", None)}),
        _sql({"running": (f"CAST(sum(volume) OVER ({W} ROWS UNBOUNDED PRECEDING) AS BIGINT)", False)}),
    ),
    "w07_rolling_quantile": (
        _custom({"p05": _of_returns("p05", 252), "p05_short": _of_returns("p05", 30)}),
        _sql({"p05": (f"quantile_cont(ret, 0.05) {_over(252)}", True),
              "p05_short": (f"quantile_cont(ret, 0.05) {_over(30)}", True)}, RETURNS),
    ),
    "w08_rolling_skewness": (
        _custom({"skew": _of_returns("skew", 252), "skew_short": _of_returns("skew", 30)}),
        _sql({"skew": (f"skewness(ret) {_over(252)}", True),
              "skew_short": (f"skewness(ret) {_over(30)}", True)}, RETURNS),
    ),
    "w09_rolling_kurtosis": (
        _custom({"kurt": _of_returns("kurt", 252), "kurt_short": _of_returns("kurt", 30)}),
        _sql({"kurt": (f"kurtosis(ret) {_over(252)}", True),
              "kurt_short": (f"kurtosis(ret) {_over(30)}", True)}, RETURNS),
    ),
    "w10_rolling_correlation": (w10_rolling_correlation, O.sql(W10)),
    "w11_row_number": (w11_row_number, O.sql(W11)),
    "x01_safe_divide": (
        _lines(("per_discount", lambda c: E.ratio(c("l_quantity"), c("l_discount"))),
               ("per_tax", lambda c: E.ratio(c("l_linenumber"), c("l_tax")))),
        _lines_sql(
            per_discount=O.r6("CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END"),
            per_tax=O.r6("CASE WHEN l_tax <> 0 THEN l_linenumber / l_tax END")),
    ),
    "x02_x06_math": (
        _lines(("size", lambda c: F.abs(c("l_tax") - c("l_discount"))),
               ("growth", lambda c: E.compound(c("px"), c("l_quantity"), 3)),
               ("root", lambda c: F.sqrt(c("px"))),
               ("log", lambda c: F.ln(c("px"))),
               ("top", lambda c: F.greatest(c("l_tax"), c("l_discount"),
                                            F.when(c("l_linenumber") > 3, 0.05)))),
        _lines_sql(size=O.r6("abs(l_tax - l_discount)"),
                   growth=O.r6("pow(px / l_quantity, 1.0 / 3) - 1"),
                   root=O.r6("sqrt(px)"), log=O.r6("ln(px)"),
                   top=O.r6("greatest(l_tax, l_discount, CASE WHEN l_linenumber > 3 THEN 0.05 END)")),
    ),
    "x07_flags": (
        _lines(("cheap", lambda c: E.flag(E.ratio(c("px"), c("l_tax")) < 20000)),
               ("marks", lambda c: E.points(c("l_tax") > 0.03, c("l_discount") > 0.03,
                                            c("l_returnflag") == "A"))),
        _lines_sql(
            cheap="CASE WHEN l_tax <> 0 AND px / l_tax < 20000 THEN 1 ELSE 0 END",
            marks="CAST(l_tax > 0.03 AS INTEGER) + CAST(l_discount > 0.03 AS INTEGER) "
                  "+ CAST(l_returnflag = 'A' AS INTEGER)"),
    ),
    "x08_x09_text": (
        _events(("has_li", lambda c: E.flag(c("event_type").like("%li%"))),
                ("has_up", lambda c: E.flag(F.lower(F.upper(c("event_type"))).contains("up"))),
                ("either", lambda c: E.flag(F.lower("event_type").rlike("click|view")))),
        _events_sql(has_li="CASE WHEN event_type LIKE '%li%' THEN 1 ELSE 0 END",
                    has_up="CASE WHEN contains(event_type, 'up') THEN 1 ELSE 0 END",
                    either="CASE WHEN regexp_matches(event_type, 'click|view') THEN 1 ELSE 0 END"),
    ),
    "x10_x13_dates": (
        _events(("age", lambda c: F.datediff(F.lit(V.EVENTS_AS_OF).cast("date"), c("date"))),
                ("week", lambda c: F.trunc("date", "week")),
                ("year", lambda c: F.year("date")),
                ("recent", lambda c: E.flag(
                    c("date") >= F.date_sub(F.lit(V.EVENTS_AS_OF).cast("date"), 7)))),
        _events_sql(age=f"CAST(DATE '{V.EVENTS_AS_OF}' - date AS INTEGER)",
                    week="CAST(date_trunc('week', date) AS DATE)",
                    year="CAST(year(date) AS INTEGER)",
                    recent=f"CASE WHEN date >= DATE '{V.EVENTS_AS_OF}' - 7 THEN 1 ELSE 0 END"),
    ),
    "x14_x15_cast_and_fill": (
        _events(("k", lambda c: F.coalesce(
                    F.get_json_object("props", "$.k").try_cast("double"), F.lit(0.0))),
                ("n", lambda c: F.coalesce(c("event_type").try_cast("int"), F.lit(-1)))),
        _events_sql(k=O.r6("coalesce(CAST(json_extract(props, '$.k') AS DOUBLE), 0)"),
                    n="coalesce(TRY_CAST(event_type AS INTEGER), -1)"),
    ),
    "x16_json": (
        _events(("k", lambda c: F.from_json("props", "k bigint")["k"]),
                ("again", lambda c: F.to_json(F.from_json("props", "k bigint")))),
        _events_sql(k="CAST(json_extract(props, '$.k') AS BIGINT)",
                    again="'{\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}'"),
    ),
    "x17_percent_change": (
        _custom({"change_1": lambda p: E.ratio(p["close"], p.lag("close")) - 1,
                 "change_volume": lambda p: E.ratio(p["volume"], p.lag("volume")) - 1}),
        _sql({"change_1": (f"close / nullif(lag(close) OVER ({W}), 0) - 1", True),
              "change_volume": (f"volume / nullif(lag(volume) OVER ({W}), 0) - 1", True)}),
    ),
}
