import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from panelgrain.operators import bars as B
from panelgrain.operators import peers as PE
from panelgrain.operators import rollup as RU
from panelgrain.operators import screens as SC
from panelgrain.operators import statements as ST
from panelgrain.operators import technical as TE
from panelgrain.operators import versions as VO
from panelgrain.operators.asof import carry_forward, carry_forward_rows

DAY0 = dt.date(2024, 1, 1)
RELAXED = settings(max_examples=8, deadline=None,
                   suppress_health_check=[HealthCheck.function_scoped_fixture])


def day(n):
    return DAY0 + dt.timedelta(days=n)


points = hs.sets(hs.tuples(hs.sampled_from("AB"), hs.integers(0, 30)), max_size=15)


@RELAXED
@given(points, points, points)
def test_carry_forward_never_looks_ahead(spark, left, one, two):
    def make(keys, name):
        rows = [(s, day(d), f"{name}{s}{d}") for s, d in keys]
        return spark.createDataFrame(rows, f"symbol string, date date, {name} string")

    for how in ("left", "inner"):
        out = carry_forward(make(left, "l"), [(make(one, "a"), ["a"]), (make(two, "b"), ["b"])], how=how)
        got = {(r["symbol"], r["date"]): (r["a"], r["b"]) for r in out.collect()}
        expected = {}
        for s, d in left:
            pair = tuple(
                (f"{n}{s}{max(c)}" if (c := [x for t, x in side if t == s and x <= d]) else None)
                for n, side in (("a", one), ("b", two)))
            if how == "left" or None not in pair:
                expected[(s, day(d))] = pair
        assert got == expected


def test_carry_keeps_null_values_of_the_newest_row(spark):
    left = spark.createDataFrame([("A", day(5), 1)], "symbol string, date date, x int")
    right = spark.createDataFrame([("A", day(1), 7), ("A", day(3), None)], "symbol string, date date, v int")
    row = carry_forward(left, [(right, ["v"])], how="inner").first()
    assert row["v"] is None and row["x"] == 1


def test_carry_for_repeated_rows(spark):
    left = spark.createDataFrame([("A", day(5), i) for i in range(3)], "symbol string, date date, i int")
    right = spark.createDataFrame([("A", day(1), 7)], "symbol string, date date, v int")
    out = carry_forward_rows(left, [(right, ["v"])]).collect()
    assert sorted((r["i"], r["v"]) for r in out) == [(0, 7), (1, 7), (2, 7)]


@RELAXED
@given(hs.dictionaries(hs.integers(0, 400), hs.integers(-100, 100), min_size=1, max_size=40),
       hs.sampled_from(["weekly", "monthly", "quarterly", "annual"]))
def test_roll_up_conserves_totals(spark, values, grain):
    df = spark.createDataFrame([("A", day(d), v) for d, v in values.items()], "symbol string, date date, v bigint")
    out = RU.roll_up(df, grain, {"v": "sum"}).collect()
    assert sum(r["v"] for r in out) == sum(values.values())
    assert len({r["date"] for r in out}) == len(out)


def test_roll_up_first_and_last_take_nulls(spark):
    df = spark.createDataFrame([("A", day(0), None, 1), ("A", day(1), 5, None)],
                               "symbol string, date date, a int, b int")
    row = RU.roll_up(df, "monthly", {"a": "first", "b": "last"}).first()
    assert row["a"] is None and row["b"] is None
    with pytest.raises(ValueError):
        RU.aggregate("mode", "a")


def test_missing_work_and_grid(spark):
    have = spark.createDataFrame([("A", day(0))], "symbol string, date date")
    grid = VO.period_grid(have, "symbol", "2024-01-01", "2024-12-31", "quarter")
    assert grid.count() == 4
    done = have.select("symbol", F.trunc("date", "quarter").alias("period_start"))
    left = VO.missing_work(grid, done, ["symbol", "period_start"])
    assert sorted(r["period_start"].month for r in left.collect()) == [4, 7, 10]


def test_universe(spark):
    rows = [("AAPL", "NASDAQ", True, False, False), ("BRK.B", "NYSE", True, False, False),
            ("BP.L", "LSE", None, False, None), ("SPY", "AMEX", True, True, False),
            ("OLD", "NYSE", False, False, False), ("OTC1", "PNK", True, False, False),
            ("FND", "NYSE", True, False, True)]
    df = spark.createDataFrame(rows, "symbol string, exchange_short string, is_actively_trading boolean, "
                                     "is_etf boolean, is_fund boolean")
    assert {r[0] for r in VO.select_universe(df, ["US"]).collect()} == {"AAPL"}
    assert {r[0] for r in VO.select_universe(df, ["us", "gb"]).collect()} == {"AAPL", "BP.L"}


def test_compaction_report(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("A", 3), ("B", 1)], "symbol string, v int")
    assert tuple(VO.compaction_report(df, ["symbol"], 2).first()) == (3, 1)
    assert tuple(VO.compaction_report(df.limit(0), ["symbol"], 2).first()) == (0, 0)


@RELAXED
@given(hs.lists(hs.tuples(hs.sampled_from("xy"), hs.integers(-4, 4)), min_size=1, max_size=25))
def test_peer_statistics_against_brute_force(spark, rows):
    import statistics

    df = spark.createDataFrame([(i, DAY0, g, float(v)) for i, (g, v) in enumerate(rows)],
                               "i int, date date, sector string, v double")
    out = {r["i"]: r for r in PE.peer_statistics(df, "v").collect()}
    for i, (g, v) in enumerate(rows):
        peers = [float(w) for h, w in rows if h == g]
        assert out[i]["peer_median"] == statistics.median(peers)
        if len(peers) > 1:
            assert out[i]["peer_percentile"] == pytest.approx(sum(w < v for w in peers) / (len(peers) - 1))
        else:
            assert out[i]["peer_percentile"] is None


def test_movers_and_screen(spark):
    df = spark.createDataFrame([("A", DAY0, 3.0), ("B", DAY0, 1.0), ("C", DAY0, None), ("D", DAY0, -2.0)],
                               "symbol string, date date, chg double")
    top = SC.movers(df, {"up": ("chg", True), "down": ("chg", False)}, 2).collect()
    assert {(r["list"], r["rank"], r["symbol"]) for r in top} == {
        ("up", 1, "A"), ("up", 2, "B"), ("down", 1, "D"), ("down", 2, "B")}
    assert [r["symbol"] for r in SC.screen(df, at_least={"chg": 0}, order_by=["chg"], limit=1, page=1).collect()] \
        == ["A"]
    assert SC.search(df, "a", ["symbol"]).first()["distance"] == 0


def test_bars_and_adjustment(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1, 9, m), v, i) for i, (m, v) in enumerate([(1, 5.0), (4, 9.0), (2, 3.0), (6, 7.0)])],
        "symbol string, ts timestamp_ntz, value double, event_id bigint")
    rows = B.bars(ticks, "5 minutes").orderBy("bar_start").collect()
    assert [tuple(r)[2:] for r in rows] == [(5.0, 9.0, 3.0, 9.0, 3), (7.0, 7.0, 7.0, 7.0, 1)]
    prices = spark.createDataFrame([("A", day(d), 100.0) for d in range(4)], "symbol string, date date, close double")
    splits = spark.createDataFrame([("A", day(2), 2, 1), ("A", day(3), 4, 1)],
                                   "symbol string, date date, num int, den int")
    out = B.adjust_prices(prices, splits, F.col("den") / F.col("num")).orderBy("date").collect()
    assert [r["adj_close"] for r in out] == [12.5, 12.5, 25.0, 100.0]


def test_statements(spark):
    df = spark.createDataFrame([("A", day(90 * i), 10 * (i + 1)) for i in range(5)],
                               "symbol string, date date, revenue bigint")
    ttm = [r["ttm_revenue"] for r in ST.trailing_sums(df, ["revenue"]).orderBy("date").collect()]
    assert ttm == [None, None, None, 100, 140]
    grown = [r["growth_revenue"] for r in ST.growth_table(df, ["revenue"]).orderBy("date").collect()]
    assert grown == [None, 1.0, 0.5, pytest.approx(1 / 3), 0.25]
    changes = spark.createDataFrame([("A", day(3), True), ("A", day(6), False)],
                                    "symbol string, date date, added boolean")
    asked = spark.createDataFrame([("A", day(d)) for d in (1, 3, 5, 6)], "symbol string, date date")
    got = ST.member_on_date(asked, changes).orderBy("date").collect()
    assert [r["is_member"] for r in got] == [0, 1, 1, 0]


def test_windowed_indicators(spark):
    closes = [1.0, 2.0, 4.0, 8.0]
    df = spark.createDataFrame([("A", day(i), c + 1, c - 1, c) for i, c in enumerate(closes)],
                               "symbol string, date date, high double, low double, close double")
    out = TE.with_technical(df, {"s": ("sma", 3), "w": ("wma", 3), "r": ("williams", 3)}).orderBy("date").collect()
    assert [r["s"] for r in out] == [None, None, pytest.approx(7 / 3), pytest.approx(14 / 3)]
    assert out[2]["w"] == pytest.approx((3 * 4 + 2 * 2 + 1) / 6)
    assert out[3]["r"] == pytest.approx(-100 * (9 - 8) / (9 - 1))
    with pytest.raises(ValueError):
        TE.with_technical(df, {"x": ("vwma", 3)})


def test_long_weighted_mean_equals_its_definition(spark):
    closes = [float(k * 37 % 101) if k != 70 else None for k in range(300)]
    df = spark.createDataFrame([("A", day(k), c) for k, c in enumerate(closes)],
                               "symbol string, date date, close double")
    got = [r["w"] for r in TE.with_technical(df, {"w": ("wma", 50)}).orderBy("date").collect()]
    for k, value in enumerate(got):
        frame = closes[k - 49:k + 1] if k >= 49 else [None]
        expected = None if None in frame else sum((i + 1) * c for i, c in enumerate(frame)) / (50 * 51 / 2)
        assert value == (None if expected is None else pytest.approx(expected))


def test_peers_with_outlier_infinity_and_missing_values(spark):
    values = [float(k % 40) for k in range(200)] + [1e12, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(k, "g", v) for k, v in enumerate(values)], "id int, g string, v double")
    got = {r["id"]: r for r in PE.peer_statistics(df, "v", ["g"]).collect()}
    known = [v for v in values if v is not None and v == v]
    for k, v in enumerate(values):
        if v is None or v != v:
            assert got[k]["peer_percentile"] is None
        else:
            assert got[k]["peer_median"] == sorted(known)[len(known) // 2 - 1] / 2 + sorted(known)[len(known) // 2] / 2
            assert got[k]["peer_percentile"] == pytest.approx(sum(x < v for x in known) / (len(known) - 1))


@pytest.mark.parametrize("parts", [1, 7])
def test_a_long_series_spreads_over_tasks(spark, parts, monkeypatch):
    import random

    from panelgrain.operators import recursive as R

    rng = random.Random(2)
    rows = [(("A", None, "B")[rng.randrange(8) // 3 % 3], k, None if rng.random() < 0.1 else rng.gauss(5, 2)) for k in range(4_000)]
    df = spark.createDataFrame(rows, "symbol string, at long, value double").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt, settle = [], R.settled
        monkeypatch.setattr(R, "settled", lambda d: dealt.append(settle(d)) or dealt[-1])
        out = R.long_ema(df, 20, "value", ["at"])
        got = {r["at"]: r["ema"] for r in out.collect()}
        used = dealt[0].where("symbol = 'A'").select("__chunk").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (used > 1) == (parts > 1)
    for symbol in ("A", None, "B"):
        series = [(k, v) for s, k, v in rows if s == symbol]
        want = R.ema(np.array([np.nan if v is None else v for _, v in series]), 20)
        for (k, v), w in zip(series, want):
            assert (got[k] is None) == (v is None) and (v is None or abs(got[k] - w) < 1e-9)
    assert R.long_ema(df.limit(0), 20, "value", ["at"]).count() == 0
