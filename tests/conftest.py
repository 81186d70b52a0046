import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelgrain.plans.session import local_session

    session = local_session(4, "4g", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def price_rows():
    """Two days of one symbol in payload form."""
    return [
        {"symbol": "AAPL", "date": "2024-01-15", "open": 180.0, "high": 185.0, "low": 179.0,
         "close": 180.0, "adjClose": 180.0, "volume": 50_000_000, "vwap": 182.0, "change": 3.0,
         "changePercent": 1.5},
        {"symbol": "AAPL", "date": "2024-01-16", "open": 183.0, "high": 186.0, "low": 182.0,
         "close": 185.0, "adjClose": 185.0, "volume": 48_000_000, "vwap": 184.0, "change": 2.0,
         "changePercent": 1.1},
    ]


@pytest.fixture
def store(spark, tmp_path):
    from panelgrain import VersionedStore

    return VersionedStore(spark, str(tmp_path / "store"))
