import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_tables import TYPES, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), TYPES)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TYPES)


@pytest.fixture(scope="session")
def plain():
    """(doc_id, text) of the odd table."""
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="session")
def repeats(spark):
    """The odd table with rows that repeat, and rows without id."""
    rows = odd_rows()
    more = [(None, *r[1:]) for r in rows[8:12]]
    return spark.createDataFrame([*rows, *rows[5:16], *more], TYPES)
