import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parity import session


@pytest.fixture(scope="session")
def spark():
    return session("4", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a int, b string", [(1, "x"), ...])"""
    return lambda schema, rows: spark.createDataFrame(rows, schema)
