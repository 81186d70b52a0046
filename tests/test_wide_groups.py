"""Fuzzy search, validity intervals and medians of groups of any size, against scans."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from panelgrain.operators import medians as ME
from panelgrain.operators import search as SE
from panelgrain.operators import validity as VA
from panelgrain.operators.statements import member_on_date


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_every_name_within_the_distance_is_found(spark, distance):
    rng = random.Random(distance)
    letters = "abé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 12))) for _ in range(300)] + ["aaaaaaaa", "AaAaAa", "", "x"]
    names = spark.createDataFrame([(k, w.upper() if k % 3 else w) for k, w in enumerate(words)] + [(999, None)], "id int, name string")
    asked = words[:40] + ["", "a", "ab", "aaaaa", "zzz", "zzzzzzzzzzzz"]
    queries = spark.createDataFrame([(q,) for q in asked + asked[:3]] + [(None,)], "query string")
    got = {(r["id"], r["query"], r["distance"]) for r in SE.fuzzy_search(names, "name", queries, distance).collect()}
    want = {(k, q, d) for k, w in enumerate(words) for q in set(x.lower() for x in asked) if (d := edits(w.lower(), q)) <= distance}
    assert got == want


def test_a_query_joins_its_rarest_trigrams(spark):
    names = spark.createDataFrame([(f"common name {k:05d}",) for k in range(500)], "name string")
    queries = spark.createDataFrame([("common name 00077",)], "query string")
    met = SE.candidates(names, "name", queries, 1)
    assert met.count() < 250  # of 500 that share most trigrams
    assert SE.fuzzy_search(names, "name", queries, 0).count() == 1


def test_intervals_hold_their_days(spark):
    day = dt.date.fromisoformat
    changes = [("A", "2020-12-30", 1, True), ("A", "2020-12-30", 2, False), ("A", "2022-03-01", 1, True), ("A", "2022-03-01", 0, False),
               ("B", "2021-01-01", 1, True), ("C", None, 1, True), ("D", "2023-06-01", 1, None), ("D", "2021-06-01", 1, True)]
    frame = spark.createDataFrame([(s, d and day(d), k, v) for s, d, k, v in changes], "symbol string, date date, seq int, added boolean")
    spans = VA.validity(frame, "added", ["seq"])
    assert {tuple(r) for r in spans.collect()} == {
        ("A", day("2020-12-30"), day("2022-02-28"), False), ("A", day("2022-03-01"), None, True), ("B", day("2021-01-01"), None, True),
        ("D", day("2021-06-01"), day("2023-05-31"), True), ("D", day("2023-06-01"), None, None)}
    days = ["2020-12-29", "2020-12-30", "2021-01-01", "2022-02-28", "2022-03-01", "2024-12-31"]
    rows = spark.createDataFrame([(s, day(d), k) for s in "ABCDE" for k, d in enumerate(days * 2)] + [("A", None, 99), (None, day(days[0]), 98)],
                                 "symbol string, date date, event int")
    got = VA.join_valid(rows, spans, "added")
    assert got.columns == ["symbol", "date", "event", "added"] and got.count() == rows.count()

    def value(symbol, when):
        held = [(d, k, v) for s, d, k, v in changes if s == symbol and d is not None and when is not None and day(d) <= when]
        return max(held, key=lambda x: x[:2])[2] if held else None
    assert all(r["added"] == value(r["symbol"], r["date"]) for r in got.collect())
    assert VA.join_valid(rows, spans.limit(0), "added").where("added IS NOT NULL").count() == 0
    assert VA.join_valid(rows.limit(0), spans, "added").count() == 0
    # One change a day: the same as the carried form.
    single = frame.where("symbol IN ('B', 'D')").select("symbol", "date", "added")
    carried = member_on_date(rows.where("symbol IS NOT NULL AND date IS NOT NULL"), single)
    joined = VA.join_valid(rows.where("symbol IS NOT NULL AND date IS NOT NULL"), VA.validity(single, "added"), "added")
    assert (sorted(map(tuple, carried.collect()))
            == sorted(map(tuple, joined.withColumn("is_member", F.coalesce("added", F.lit(False)).cast("int")).drop("added").collect())))


@pytest.mark.parametrize("parts", [1, 6])
def test_medians_of_large_groups(spark, parts):
    rng = random.Random(1)
    rows = [("hot", rng.choice((1.0, 2.0, rng.random() * 100))) for _ in range(3_000)]
    rows += [("even", float(k)) for k in range(4)] + [("odd", float(k)) for k in range(5)] + [("ties", 7.0)] * 9
    rows += [(None, 3.0), (None, 5.0), ("none", None), ("nan", float("nan")), ("odd", None), ("two", -1e300), ("two", 1e300)]
    keys = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "symbol string, value double").repartition(4)
        got = {r["symbol"]: r["median"] for r in ME.medians(df, "value").collect()}
        assert ME.medians(df.limit(0), "value").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    groups = {}
    for s, v in rows:
        if v is not None and v == v:
            groups.setdefault(s, []).append(v)
    assert got == {s: statistics.median(v) for s, v in groups.items()}
