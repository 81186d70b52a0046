import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def make(spark):
    from conftest_llm import SCHEMA, rows_of

    return lambda pairs, lang="en": spark.createDataFrame(rows_of(pairs, lang), SCHEMA)
