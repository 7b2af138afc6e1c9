"""Registered queries: one callable per operator / data product, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables whole (``lineitem``, ``part``, ``events``) and
derives its input with Spark; none runs on fixed small input. Parameters that select
a slice of the bars (upsert split date, history start, horizon) are the operators'
own parameters, not row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.operators import gold, horizons, quality, seasonality
from barmarts.operators.asof import asof_join
from barmarts.operators.enrich import with_dimension
from barmarts.operators.normalise import history_since, newest_bar_per_symbol, normalise_landing
from barmarts.operators.ranking import global_rank
from barmarts.operators.silver import silver
from barmarts.operators.upsert import read_bronze, upsert, upsert_into_path
from barmarts.plans.pipeline import data_tests, historical_load, incremental_load, materialise_marts
from barmarts.plans.stored_queries import stored_queries
from barmarts.schemas import ALERT_SEVERITIES, ALERT_TYPES, DEFAULT_UNIVERSE, LOAD_TYPES
from barmarts.session import shared_dir
from barmarts.sources.landing import (consolidate, read_dimension, read_landing, read_vendor_csv,
                                      universe_frame, write_landing)
from barmarts.sources.tables import bars_from_tables, brand_dimension, bronze_table, read_table

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed query parameters -------------------------------------------------------------
UPSERT_TARGET_BEFORE = "2001-06-01"      # target = bars before this date
UPSERT_BATCH_FROM = "2001-05-01"         # batch = bars from this date, adjusted_close * 2
HISTORY_START = "1998-01-01"
DROP_B = ("2001-06-15", "2001-08-01")    # second landed drop: repeats bars of the symbols below
DROP_B_SYMBOLS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]
ACCEPTED_SYMBOLS = [f"Brand#{i}" for i in range(1, 21)]
ACCEPTED_PROVIDERS = ["synthetic"]
LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
RANKING_HORIZON = "3M"


def _bars(spark, sf):
    """Bronze: derived from lineitem x part once per input snapshot, then read as a table."""
    return bronze_table(spark, sf)


def _silver(spark, sf):
    return silver(_bars(spark, sf))


def _monthly(spark, sf):
    return gold.monthly_performance(_silver(spark, sf))


def _upsert_inputs(spark, sf):
    bars = _bars(spark, sf)
    target = bars.where(F.col("price_date") < F.lit(UPSERT_TARGET_BEFORE).cast("date"))
    batch = (bars.where(F.col("price_date") >= F.lit(UPSERT_BATCH_FROM).cast("date"))
             .withColumns({"adjusted_close": F.col("adjusted_close") * 2,
                           "load_type": F.lit("incremental")}))
    return target, batch


def _landed_drops(spark, sf):
    bars = _bars(spark, sf)
    pd = F.col("price_date")
    again = bars.where((pd >= F.lit(DROP_B[0]).cast("date")) & (pd < F.lit(DROP_B[1]).cast("date"))
                       & F.col("symbol").isin(DROP_B_SYMBOLS))
    return bars.unionByName(again)


def _vendor_shaped(spark, sf):
    bars = _bars(spark, sf)
    return bars.select(
        F.col("symbol").alias(" Symbol "), F.col("price_date").cast("string").alias("Date"),
        F.col("open").cast("string").alias("Open"), F.col("high").cast("string").alias("High"),
        F.col("low").cast("string").alias("Low"), F.col("close").cast("string").alias("Close"),
        F.col("adjusted_close").cast("string").alias(" Adj Close "),
        F.col("volume").cast("string").alias("Volume"))


def normalise_landing_q(spark, sf):
    return normalise_landing(_vendor_shaped(spark, sf), source_provider="yahoo_finance",
                             load_type="historical", batch_id="batch-1",
                             ingested_at_utc="2024-01-02 00:00:00")


def upsert_bars(spark, sf):
    target, batch = _upsert_inputs(spark, sf)
    return upsert(target, batch)


def asof_join_events(spark, sf):
    ev = read_table(spark, sf, "events")
    clicks = ev.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_event_id"), "user_id", F.col("ts").alias("click_ts"),
        F.col("value").alias("click_value"))
    views = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("event_id"), "ts", "value")
    return asof_join(clicks, views, key="user_id", left_ts="click_ts", right_ts="ts",
                     right_cols=["event_id", "value"], bucket="day", prefix="view_")


def bars_with_dimension(spark, sf):
    return with_dimension(_bars(spark, sf), brand_dimension(read_table(spark, sf, "part")))


def _stored(spark, sf, marts=None):
    """Bronze and the marts, written in order; the data tests read the written tables."""
    bars = _bars(spark, sf)
    return bars, materialise_marts(spark, bars, shared_dir(spark, "tested-marts"), marts=marts)


def _data_tests(spark, sf):
    bars, marts = _stored(spark, sf)
    return data_tests(bars, marts, ACCEPTED_SYMBOLS, ACCEPTED_PROVIDERS)


def dq_not_null(spark, sf):
    return _data_tests(spark, sf).where("check = 'not_null'").drop("passed")


def dimension_file_join(spark, sf):
    """The dimension written as a file (all five columns), read back and joined."""
    root = shared_dir(spark, "dimension")
    part = read_table(spark, sf, "part")
    (part.groupBy(F.col("p_brand").alias("symbol")).agg(
        F.min("p_name").alias("name"), F.min("p_type").alias("asset_class"),
        F.min(F.substring("p_type", 1, 3)).alias("region"), F.max("p_size").cast("string").alias("category"))
     .write.json(f"{root}/dim"))
    return with_dimension(_bars(spark, sf), read_dimension(spark, f"{root}/dim"))


def missing_from_universe(spark, sf):
    """Configured symbols without a bar."""
    return quality.missing_symbols(_bars(spark, sf), universe_frame(spark, [*ACCEPTED_SYMBOLS, *DEFAULT_UNIVERSE]))


def monthly_positions(spark, sf):
    """O1 with the row's place in the final order made explicit."""
    rows = _monthly(spark, sf).select("symbol", "month_start_date", "monthly_return_pct")
    return global_rank(rows, [F.col("symbol").asc(), F.col("month_start_date").asc()], name="position")


def alert_positions(spark, sf):
    """O2 with the row's place made explicit (inside a month by symbol)."""
    rows = gold.alert_candidates(_monthly(spark, sf)).select("symbol", "month_start_date", "alert_type")
    return global_rank(rows, [F.col("month_start_date").desc(), F.col("symbol").asc()], name="position")


def dq_unique(spark, sf):
    keys = {"long_term": "symbol", "risk": "symbol", "market_summary": "month_start_date"}
    _, marts = _stored(spark, sf, list(keys))
    return quality.union_reports([quality.unique_report(marts[t], t, [key]) for t, key in keys.items()])


def dq_accepted_values(spark, sf):
    _, marts = _stored(spark, sf, ["alerts"])
    return quality.union_reports([
        quality.accepted_values_multi(marts["silver"], "silver", {"symbol": ACCEPTED_SYMBOLS,
                                                                  "source_provider": ACCEPTED_PROVIDERS,
                                                                  "data_loaded_as": LOAD_TYPES}),
        quality.accepted_values_multi(marts["alerts"], "alerts", {"alert_type": ALERT_TYPES,
                                                                  "alert_severity": ALERT_SEVERITIES}),
    ])


def dq_composite_key(spark, sf):
    bars, marts = _stored(spark, sf, [])
    return quality.union_reports([
        quality.unique_report(bars, "bronze", ["symbol", "price_date"], "composite_key"),
        quality.unique_report(marts["silver"], "silver", ["symbol", "price_date"], "composite_key"),
        quality.unique_report(marts["monthly"], "monthly", ["symbol", "month_start_date"], "composite_key"),
        quality.unique_report(read_table(spark, sf, "lineitem"), "lineitem", LINEITEM_KEY, "composite_key"),
    ])


def dq_recompute(spark, sf):
    return quality.recompute_report(_stored(spark, sf, [])[1]["monthly"])


def gate_report(spark, sf):
    universe = read_table(spark, sf, "part").select(F.col("p_brand").alias("symbol")).distinct()
    return quality.gate_report(_landed_drops(spark, sf), universe)


def partitioned_landing_roundtrip(spark, sf):
    root = shared_dir(spark, "landing-roundtrip")
    write_landing(_bars(spark, sf), f"{root}/landing", "historical")
    return consolidate(spark, f"{root}/landing", f"{root}/consolidated")


def landing_profile(spark, sf):
    """A11 over a landed tree: land the bars, read the whole tree back, profile per symbol."""
    root = shared_dir(spark, "landing-profile")
    write_landing(_bars(spark, sf), f"{root}/landing", "historical")
    return quality.profile_by_symbol(read_landing(spark, f"{root}/landing"))


def stream_upsert(spark, sf):
    from barmarts.streaming.ingest import run_available_now
    root = shared_dir(spark, "stream-upsert")
    target, batch = _upsert_inputs(spark, sf)
    upsert_into_path(spark, f"{root}/bronze", target)
    # three landed drops of the batch, one after the other (months in order), a few files each
    pd = F.col("price_date")
    cuts = ["2001-06-01", "2001-08-01"]
    drops = [batch.where(pd < F.lit(cuts[0]).cast("date")),
             batch.where((pd >= F.lit(cuts[0]).cast("date")) & (pd < F.lit(cuts[1]).cast("date"))),
             batch.where(pd >= F.lit(cuts[1]).cast("date"))]
    for d in drops:
        d.coalesce(3).write.mode("append").option("header", True).csv(f"{root}/landing")
    return run_available_now(spark, f"{root}/landing", f"{root}/bronze", checkpoint=f"{root}/checkpoint",
                             max_files_per_trigger=4)  # several micro-batches


def _land_vendor_csv(spark, sf, root):
    vendor = _vendor_shaped(spark, sf)
    vendor.write.option("header", True).csv(f"{root}/landing")
    return read_vendor_csv(spark, f"{root}/landing")


def historical_backfill(spark, sf):
    """Landed vendor CSV -> P1-P6 -> Q15 (historical policy) -> upsert into Bronze."""
    root = shared_dir(spark, "historical-backfill")
    historical_load(spark, _land_vendor_csv(spark, sf, root), f"{root}/bronze",
                    "yahoo_finance", "batch-1", "2024-01-02 00:00:00")
    return read_bronze(spark, f"{root}/bronze")


def incremental_daily(spark, sf):
    """Newest landed bar per symbol -> Q11-Q14 (universe = brands of part) -> upsert."""
    root = shared_dir(spark, "incremental-daily")
    target, _ = _upsert_inputs(spark, sf)
    upsert_into_path(spark, f"{root}/bronze", target)
    universe = read_table(spark, sf, "part").select(F.col("p_brand").alias("symbol")).distinct()
    return incremental_load(spark, _land_vendor_csv(spark, sf, root),
                            f"{root}/bronze", universe, "yahoo_finance", "batch-2", "2024-01-03 00:00:00")


def materialised_alerts(spark, sf):
    """Every model written in order (Q9 first); the written alerts table."""
    written = materialise_marts(spark, _bars(spark, sf), shared_dir(spark, "materialised-marts"))
    return written["alerts"].drop("gold_created_at_utc")


def all_queries() -> dict[str, Query]:
    sv, mo = _silver, _monthly
    return {
        "bars_daily": bars_from_tables,
        "silver_prices": sv,
        "long_term_performance": lambda s, sf: gold.long_term_performance(sv(s, sf)),
        "long_term_performance_join_form": lambda s, sf: gold.long_term_performance_join_form(sv(s, sf)),
        "monthly_performance": mo,
        "monthly_performance_join_form": lambda s, sf: gold.monthly_performance_join_form(sv(s, sf)),
        "monthly_market_summary": lambda s, sf: gold.monthly_market_summary(mo(s, sf)),
        "risk_summary": lambda s, sf: gold.risk_summary(mo(s, sf)),
        "alert_candidates": lambda s, sf: gold.alert_candidates(mo(s, sf)),
        "top_k_per_month": lambda s, sf: gold.top_k_per_month(mo(s, sf), k=3),
        "table_profile": lambda s, sf: quality.table_profile(_bars(s, sf)),
        "profile_by_symbol": lambda s, sf: quality.profile_by_symbol(_bars(s, sf)),
        "duplicate_keys": lambda s, sf: quality.duplicate_keys(read_table(s, sf, "lineitem"), LINEITEM_KEY),
        "duplicate_row_count": lambda s, sf: quality.duplicate_row_count(read_table(s, sf, "lineitem"),
                                                                         LINEITEM_KEY),
        "upsert_bars": upsert_bars,
        "newest_bar_per_symbol": lambda s, sf: newest_bar_per_symbol(_bars(s, sf)),
        "history_since": lambda s, sf: history_since(_bars(s, sf), HISTORY_START),
        "normalise_landing": normalise_landing_q,
        "bars_with_dimension": bars_with_dimension,
        "snapshot_30d": lambda s, sf: horizons.snapshot_30d(sv(s, sf)),
        "snapshot_kpis": lambda s, sf: horizons.snapshot_kpis(horizons.snapshot_30d(sv(s, sf))),
        "return_ranking": lambda s, sf: horizons.return_ranking(horizons.snapshot_30d(sv(s, sf))),
        "freshness": lambda s, sf: horizons.freshness(sv(s, sf)),
        "horizon_returns": lambda s, sf: horizons.horizon_returns(sv(s, sf)),
        "horizon_ranking": lambda s, sf: horizons.horizon_ranking(horizons.horizon_returns(sv(s, sf)),
                                                                   RANKING_HORIZON),
        "asof_join_events": asof_join_events,
        "growth_of_100": lambda s, sf: horizons.growth_of_100(sv(s, sf), months=12),
        "seasonality_heatmap": lambda s, sf: seasonality.seasonality_heatmap(mo(s, sf)),
        "seasonality_leaders": lambda s, sf: seasonality.seasonality_leaders(mo(s, sf)),
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_accepted_values": dq_accepted_values,
        "dq_composite_key": dq_composite_key,
        "dq_recompute": dq_recompute,
        "data_tests": _data_tests,
        "gate_report": gate_report,
        "split_rejects": lambda s, sf: quality.split_rejects(_landed_drops(s, sf), policy="historical"),
        "partitioned_landing_roundtrip": partitioned_landing_roundtrip,
        "landing_profile": landing_profile,
        "stream_upsert": stream_upsert,
        "historical_backfill": historical_backfill,
        "incremental_daily": incremental_daily,
        "materialised_alerts": materialised_alerts,
        "dimension_file_join": dimension_file_join,
        "missing_from_universe": missing_from_universe,
        "monthly_positions": monthly_positions,
        "alert_positions": alert_positions,
        **stored_queries(),
    }
