"""Plan assertions: one Window node in Silver, pruned and pushed-down scans, no Python
evaluation anywhere, no single-partition exchange in the per-key marts."""
import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from barmarts.operators.silver import silver
from barmarts.plans.registry import all_queries
from barmarts.sources.tables import bronze_table
from conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
            "PythonMapInArrow", "AggregateInPandas")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_tree(df):
    return plan(df).split("\n\n")[0]


def test_silver_has_one_window(spark):
    p = physical_tree(silver(bronze_table(spark, SF_SMALL), split_by=None))
    assert len(re.findall(r"\bWindow\b \(", p)) == 1, p
    assert "SinglePartition" not in p


def test_split_silver_windows_by_symbol_and_month(spark):
    text = plan(silver(bronze_table(spark, SF_SMALL)))
    # the window holding the full rows (the one computing the lags) is keyed by (symbol, chunk)
    lag_windows = [b for b in text.split("\n\n") if ") Window" in b and "lag(" in b]
    assert lag_windows, text
    for b in lag_windows:
        spec = re.search(r"Arguments: \[.*\], \[([^\]]*)\], \[", b).group(1)
        assert "symbol" in spec and "_chunk" in spec, spec
    assert "SinglePartition" not in physical_tree(silver(bronze_table(spark, SF_SMALL)))


def test_asof_window_is_keyed_by_bucket(spark):
    text = plan(E.queries()["asof_join_events"](spark, SF_SMALL))
    wins = [b for b in text.split("\n\n") if ") Window" in b and "last(" in b and "_r" in b]
    specs = [re.search(r"Arguments: \[.*\], \[([^\]]*)\], \[", b).group(1) for b in wins]
    assert any("_k" in x and "_b" in x for x in specs), specs


def test_scan_is_pruned_and_filter_pushed(spark):
    lt = E.queries()["long_term_performance"](spark, SF_SMALL)
    text = plan(lt)
    schema = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert schema and all("open" not in s and "batch_id" not in s for s in schema), schema
    hs = plan(E.queries()["history_since"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(price_date", hs), hs


NO_SINGLE = ["silver_prices", "long_term_performance", "monthly_performance", "monthly_market_summary",
             "risk_summary", "alert_candidates", "top_k_per_month", "horizon_returns", "snapshot_30d",
             "asof_join_events", "growth_of_100", "seasonality_heatmap", "upsert_bars",
             "newest_bar_per_symbol", "bars_with_dimension", "split_rejects", "profile_by_symbol"]


@pytest.mark.parametrize("key", NO_SINGLE)
def test_no_single_partition_exchange(spark, key):
    p = physical_tree(E.queries()[key](spark, SF_SMALL))
    assert "SinglePartition" not in p, p


SIDE_EFFECTS = {"partitioned_landing_roundtrip", "stream_upsert", "historical_backfill", "landing_profile",
                "incremental_daily", "materialised_alerts", "backfill_report", "published_alerts", "stream_newest_bars",
                "stream_closed_days", "silver_refresh"}


@pytest.mark.parametrize("key", sorted(set(all_queries()) - SIDE_EFFECTS))
def test_no_python_in_plan(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL), "extended")
    assert not any(n in p for n in PY_NODES), key


def test_top_k_limits_before_shuffle(spark):
    p = physical_tree(E.queries()["top_k_per_month"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_upsert_rewrites_only_touched_months(spark):
    from pyspark.sql import functions as F
    from barmarts.operators.upsert import read_pointer, upsert_into_path
    from barmarts.session import shared_dir
    from barmarts.sources.tables import bars_from_tables
    bars = bars_from_tables(spark, SF_SMALL)
    path = shared_dir(spark, "test-touched") + "/t"
    upsert_into_path(spark, path, bars)
    before = read_pointer(spark, path)["months"]
    upsert_into_path(spark, path, bars.where(F.col("price_date") >= "2001-10-01"))
    after = read_pointer(spark, path)["months"]
    assert set(after) == set(before) and {m for m in after if after[m] != before[m]} == {m for m in after if m >= "2001-10"}


def test_silver_reads_bronze_twice(spark):
    p = physical_tree(E.queries()["silver_prices"](spark, SF_SMALL))
    assert p.count("Scan parquet") <= 2 and len(re.findall(r"(?<![A-Za-z])Exchange ", p)) <= 4
