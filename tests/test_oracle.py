"""Every registered query against its DuckDB oracle (the driver's gate, run on sf0.001)."""
import pytest

import __spark_entry__ as E
from barmarts.plans.registry import all_queries
from conftest import SF_SMALL
from oracle_harness import compare

KEYS = sorted(all_queries())  # the optional part has its own tests


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "monthly_return_pct" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, key):
    r = compare(E.queries()[key](spark, SF_SMALL), E.oracle_sql()[key], SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
