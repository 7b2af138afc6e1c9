import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barmarts.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app="barmarts-tests")
    yield s
    s.stop()


def _bar(sym, day, adj, open_=10.0, high=11.0, low=9.0, close=10.0, volume=1000):
    return (sym, dt.date.fromisoformat(day), open_, high, low, close, adj, volume,
            "synthetic", "historical", "batch-0", dt.datetime(2024, 1, 1))


# FIXTURES.md section 3: 17 edge bars, one row set per trap.
EDGE_ROWS = [
    _bar("AAA", "2024-01-02", 100.0),
    _bar("AAA", "2024-01-03", 101.0),
    _bar("AAA", "2024-01-04", 500.0, high=8.0),          # high < low -> dropped
    _bar("AAA", "2024-01-05", 99.0),
    _bar("AAA", "2024-01-08", 102.0),
    _bar("AAA", "2024-01-09", 103.0),
    _bar("AAA", "2024-01-10", 110.0),
    _bar("AAA", "2024-02-01", 50.0),
    _bar("AAA", "2024-02-29", 53.998),
    _bar("BBB", "2024-01-31", 20.0),
    _bar("BBB", "2024-02-01", 0.0),
    _bar("BBB", "2024-02-15", 7.0, high=None),           # high NULL -> dropped
    _bar("BBB", "2024-02-16", 8.0, volume=None),         # volume NULL -> dropped
    _bar("BBB", "2024-02-20", 4.0, open_=None),          # open NULL -> kept, fails not_null
    _bar("BBB", "2024-02-29", 5.0),
    _bar("CCC", "2024-01-02", 10.0),
    _bar("CCC", "2024-01-31", 9.2),
]


@pytest.fixture(scope="session")
def edge_bronze(spark):
    from barmarts.schemas import BRONZE
    from pyspark.sql import types as T
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in BRONZE.fields])
    return spark.createDataFrame(EDGE_ROWS, nullable)
