"""Registered queries beside their SQL at the smallest scale; `python -m workload.check` runs all."""

import os

import pytest

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "s01_typed_append", "s06_x16_json_payloads", "v01_latest_per_key", "v10_missing_work",
    "j02_flagship_carry_forward", "j02_native_grain_features", "j03_rolled_and_native",
    "j05_date_only_rolled", "a10_weekly", "f107_f136_growth", "f183_f202_risk",
    "f247_f266_composite", "f314_f332_historical", "p01_p08_w12_smoothing", "p10_w13_dividend_streak",
    "p16_p23_j07_insider_signals", "r03_movers", "r16_adjusted_prices", "r21_peer_statistics",
    "t03_stream_bars",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_query_has_an_entry_and_aliased_columns():
    import __spark_entry__ as entry

    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 100


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    import __spark_entry__ as entry
    from workload.check import compare, duck, rows_of

    df = entry.queries()[name](spark, SF)
    cur = duck(SF).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert compare(rows_of(df.columns, df.collect()), rows_of(columns, cur.fetchall())) is None
