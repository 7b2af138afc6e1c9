"""Compositions the user calls: the Bronze -> Silver -> Gold build (G1-G6 with audit
stamps), the historical backfill (G7) and the daily incremental load (G8).

Only the gate reports and the writers run actions; everything else stays lazy, so
Catalyst and AQE plan each mart across the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barmarts.operators import gold
from barmarts.operators.normalise import newest_bar_per_symbol, normalise_landing
from barmarts.operators.observed import batch_metrics, judge, observed, store_observed
from barmarts.operators.quality import (GateError, duplicate_row_count, enforce_gates, missing_symbols, split_rejects,
                                        union_reports, unique_report, value_report)
from barmarts.schemas import (ALERT_COLUMNS, ALERT_SEVERITIES, ALERT_TYPES, DEFAULT_PROVIDER,
                              DEFAULT_UNIVERSE, LOAD_TYPES, LONG_TERM_COLUMNS,
                              MARKET_SUMMARY_COLUMNS, MONTHLY_COLUMNS, RISK_COLUMNS,
                              SILVER_COLUMNS, SILVER_NULLABLE)
from barmarts.operators.silver import silver
from barmarts.operators.upsert import upsert_into_path
from barmarts.session import delete_folder, shared_dir
from barmarts.sources.landing import materialise


@dataclass
class Marts:
    silver: DataFrame
    long_term: DataFrame
    monthly: DataFrame
    market_summary: DataFrame
    risk: DataFrame
    alerts: DataFrame


def build_marts(bronze: DataFrame, split_by: str | None = "month", audit: bool = True) -> Marts:
    s = silver(bronze, split_by=split_by, audit=audit)
    base = s.drop("silver_created_at_utc") if audit else s
    monthly = gold.monthly_performance(base)
    return Marts(
        silver=s,
        long_term=gold.long_term_performance(base, audit=audit),
        monthly=gold._audit(monthly, audit),
        market_summary=gold.monthly_market_summary(monthly, audit=audit),
        risk=gold.risk_summary(monthly, audit=audit),
        alerts=gold.alert_candidates(monthly, audit=audit),
    )


def materialise_marts(spark: SparkSession, bronze: DataFrame, root: str, split_by: str | None = "month",
                      store: Callable[..., DataFrame] | None = None, marts: list[str] | None = None) -> dict[str, DataFrame]:
    """S6 for every model: Silver first, then the marts read the written Silver and the
    written month-by-month table (written tables cut lineage and survive executor loss).
    ``marts`` names the models wanted besides those two (default: all).

    ``store(df, name, sort_by)`` writes a model; the default replaces a folder under ``root``,
    ``sources.published.publisher`` publishes through the catalog, so that a stop or a reader in
    the middle of a rebuild sees whole tables only.

    The Bronze key check (Q9) runs first: the one-pass marts and the reference's join
    forms agree only on unique keys, so duplicates refuse the build before any write."""
    dup = unique_report(bronze, "bronze", ["symbol", "price_date"], "composite_key").first()
    if dup.failed_rows:
        raise GateError(f"Bronze has {dup.failed_rows} duplicated (symbol, price_date) keys")
    put = store or (lambda df, name, sort_by=None: materialise(df, f"{root}/{name}", sort_by=sort_by))
    s = put(silver(bronze, split_by=split_by, audit=True), "silver", ["symbol", "price_date"])
    base = s.drop("silver_created_at_utc")
    monthly = put(gold._audit(gold.monthly_performance(base), True), "monthly", ["symbol", "month_start_date"])
    m = monthly.drop("gold_created_at_utc")
    built = {
        "long_term": gold.long_term_performance(base, audit=True),
        "market_summary": gold.monthly_market_summary(m, audit=True),
        "risk": gold.risk_summary(m, audit=True),
        "alerts": gold.alert_candidates(m, audit=True),
    }
    wanted = [name for name in built if marts is None or name in marts]
    return {"silver": s, "monthly": monthly, **{name: put(built[name], name) for name in wanted}}


def historical_load(spark: SparkSession, landed: DataFrame, table_path: str, source_provider: str,
                    batch_id: str, ingested_at_utc: str, start_date: str | None = None,
                    universe: DataFrame | None = None) -> DataFrame:
    """Normalise -> start bound (F7) -> duplicate gate (Q11) -> split by symbol (Q15) ->
    upsert the good symbols.

    Duplicate keys among the rows that typed well refuse the whole batch before anything is
    written. A symbol with a value that does not cast, or a required value missing, is
    rejected with its rows, as is one with a line of another length than the header; the other
    symbols load. Returns the report: the rejected rows with ``reject_reason`` (and file and text
    of malformed lines in ``_line``), extra header lines, and one row per symbol of ``universe``
    that returned nothing.
    """
    batch = normalise_landing(landed, source_provider, "historical", batch_id, ingested_at_utc, tag_faults=True)
    if start_date is not None:
        batch = batch.where(F.col("price_date").isNull() | (F.col("price_date") >= F.to_date(F.lit(start_date))))
    # The tagged rows are written once to the shared folder, measured by that write; gate, split
    # and report read them from there (the landing is read once, lineage cut).
    stored, fault = shared_dir(spark, "backfill", batch_id), F.col("_fault")
    typed, seen = store_observed(batch, f"{stored}/typed", **batch_metrics(batch, sound=fault.isNull()))
    judge(seen, nulls=False)  # Q14; missing values reject their symbol below
    extra = duplicate_row_count(typed.where(fault.isNull())).first()["duplicate_rows"]
    if extra:  # Q11
        raise GateError(f"landing batch refused: no_duplicate_keys={extra}")
    # an extra header line belongs to no symbol's rows: it is reported, and rejects nothing else
    header = F.coalesce(fault == "header_row", F.lit(False))
    split = split_rejects(typed.where(~header), policy="historical", fault="_fault").unionByName(
        typed.where(header).drop("_fault").withColumns({"status": F.lit("rejected"), "reject_reason": F.lit("header_row")}))
    tagged, counts = store_observed(split, f"{stored}/split", accepted=F.count_if(F.col("status") == "accepted"))
    delete_folder(spark, f"{stored}/typed")
    if counts["accepted"]:
        upsert_into_path(spark, table_path, tagged.where(F.col("status") == "accepted"))
    report = tagged.where(F.col("status") == "rejected")
    if universe is None:
        return report
    silent = missing_symbols(tagged.where(F.col("reject_reason").isNull() | (F.col("reject_reason") != "header_row")), universe)
    return report.unionByName(silent.select("symbol", F.lit("rejected").alias("status"), F.lit("nothing_returned").alias("reject_reason")),
                              allowMissingColumns=True)


def incremental_load(spark: SparkSession, landed: DataFrame, table_path: str, universe: DataFrame,
                     source_provider: str, batch_id: str, ingested_at_utc: str) -> DataFrame:
    """Newest bar per symbol -> strict gates (Q11-Q14, all-or-nothing) -> upsert.

    Only the newest bars are judged: an old bar that does not cast does not refuse the day,
    one among the newest does (a row whose date does not cast is refused too)."""
    batch, day, newest = newest_batch(normalise_landing(landed, source_provider, "incremental", batch_id, ingested_at_utc, tag_faults=True))
    stored = shared_dir(spark, "incremental", batch_id)
    batch, seen = store_observed(batch, f"{stored}/newest", **newest)  # the only pass over the landing
    bad = day.get["bad_row"] or seen["bad_newest"]
    if bad:
        raise GateError(f"landing batch refused: {bad}")
    judge(seen)  # Q12, Q14
    batch = batch.drop("_fault", "_line")
    enforce_gates(batch, universe, required=None)  # Q11, Q13, over the few rows written
    out = upsert_into_path(spark, table_path, batch)
    delete_folder(spark, stored)
    return out


def newest_batch(rows: DataFrame) -> tuple[DataFrame, Observation, dict[str, Column]]:
    """The newest bar of each symbol, with what is measured below it (``bad_row``: a row whose date
    or line is broken) and what is to be measured of it."""
    def first_fault(cond: Column) -> Column:
        return F.max(F.when(cond, F.concat(F.coalesce("symbol", F.lit("?")), F.lit(": "), "_fault")))
    fault = F.col("_fault")
    rows, day = observed(rows.where(fault.isNull() | (fault != "header_row")),
                         bad_row=first_fault(fault.isin("cast_failed:price_date", "malformed_line")))
    newest = newest_bar_per_symbol(rows)
    return newest, day, {**batch_metrics(newest), "bad_newest": first_fault(fault.isNotNull())}


MART_NAMES = ["silver", "long_term", "monthly", "market_summary", "risk", "alerts"]


def stored_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that ``materialise_marts`` wrote under ``root``."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in MART_NAMES}


def data_tests(bronze: DataFrame, marts: dict[str, DataFrame], accepted_symbols: list[str] | None = None,
               accepted_providers: list[str] | None = None) -> DataFrame:
    """The whole data-test suite over the stored tables as one report (81 rows): not_null on
    Bronze (4), Silver (14) and every Gold column (51), audit stamps included; unique keys of
    long-term, risk and market summary; accepted values of symbol, provider, load type, alert
    type and severity; composite keys of Bronze, Silver and month-by-month; the monthly
    recompute check. Nothing is rebuilt: each table is read once for its values and once for
    its key. One row per test with ``passed``."""
    symbols = accepted_symbols if accepted_symbols is not None else DEFAULT_UNIVERSE
    providers = accepted_providers if accepted_providers is not None else [DEFAULT_PROVIDER]
    gold_columns = {"long_term": LONG_TERM_COLUMNS, "monthly": MONTHLY_COLUMNS, "risk": RISK_COLUMNS,
                    "market_summary": MARKET_SUMMARY_COLUMNS, "alerts": ALERT_COLUMNS}
    accepted = {"silver": {"symbol": symbols, "source_provider": providers, "data_loaded_as": LOAD_TYPES},
                "alerts": {"alert_type": ALERT_TYPES, "alert_severity": ALERT_SEVERITIES}}
    reports = [
        value_report(bronze, "bronze", ["symbol", "price_date", "adjusted_close", "volume"]),
        value_report(marts["silver"], "silver", [c for c in SILVER_COLUMNS if c not in SILVER_NULLABLE] + ["silver_created_at_utc"],
                     accepted["silver"]),
        *[value_report(marts[t], t, cols + ["gold_created_at_utc"], accepted.get(t), recompute=t == "monthly")
          for t, cols in gold_columns.items()],
        unique_report(marts["long_term"], "long_term", ["symbol"]),
        unique_report(marts["risk"], "risk", ["symbol"]),
        unique_report(marts["market_summary"], "market_summary", ["month_start_date"]),
        unique_report(bronze, "bronze", ["symbol", "price_date"], "composite_key"),
        unique_report(marts["silver"], "silver", ["symbol", "price_date"], "composite_key"),
        unique_report(marts["monthly"], "monthly", ["symbol", "month_start_date"], "composite_key"),
    ]
    return union_reports(reports).withColumn("passed", F.col("failed_rows") == 0)


def assert_data_tests(report: DataFrame) -> None:
    """Raise naming every failed test (collects only the failed report rows)."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        names = ", ".join(f"{r.check}({r.table_name}.{r.column_name})={r.failed_rows}" for r in failed)
        raise GateError(f"{len(failed)} data tests failed: {names}")
