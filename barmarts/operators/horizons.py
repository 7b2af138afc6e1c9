"""Dashboard snapshots and horizon returns over cleaned bars.

The reference date is the latest ``price_date`` of the input, a scalar subquery (one
value, computed once by Spark, no join and no single-partition window). Every base
price is "the last bar on or before the target date", i.e. a backward as-of lookup;
with fixed targets it folds into conditional ``max_by`` aggregates, so all ten
horizons cost one ``groupBy(symbol)`` that combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmarts.functions.returns import ratio_pct, ratio_return_pct
from barmarts.operators.ranking import global_rank
from barmarts.schemas import HORIZON_MONTHS, HORIZONS, SNAPSHOT_DAYS

ADJ = "adjusted_closing_price"
PD = "price_date"


def reference_date(silver: DataFrame):
    return silver.select(F.max("price_date")).scalar()


def _on_or_before(target):
    """ordering column that is NULL outside the lookback window (ignored by max_by)."""
    return F.when(F.col(PD) <= target, F.col(PD))


def snapshot_30d(silver: DataFrame, days: int = SNAPSHOT_DAYS) -> DataFrame:
    """Per symbol, latest close vs the last close on or before ref - ``days``."""
    target = F.date_sub(reference_date(silver), days)
    base_ord = _on_or_before(target)
    agg = silver.groupBy("symbol").agg(
        F.max(base_ord).alias("base_date"),
        F.max_by(ADJ, base_ord).alias("base_adjusted_close"),
        F.max("price_date").alias("latest_date"),
        F.max_by(ADJ, "price_date").alias("latest_adjusted_close"),
    )
    return agg.withColumn("return_pct", ratio_return_pct("latest_adjusted_close", "base_adjusted_close"))


def snapshot_kpis(snapshot: DataFrame) -> DataFrame:
    """Average return, % positive, best and worst (NULL returns excluded; ties -> symbol)."""
    r = F.col("return_pct")
    has = r.isNotNull()
    best = F.when(has, F.struct((-r).alias("v"), F.col("symbol").alias("s")))
    worst = F.when(has, F.struct(r.alias("v"), F.col("symbol").alias("s")))
    return snapshot.agg(
        F.count(F.lit(1)).alias("symbols_count"),
        F.count(r).alias("symbols_with_return"),
        F.round(F.avg(r), 2).alias("avg_return_pct"),
        ratio_pct(F.sum(F.when(r > 0, 1).otherwise(0)), F.count(r)).alias("positive_pct"),
        F.min_by("symbol", best).alias("best_symbol"),
        F.round(F.max(r), 2).alias("best_return_pct"),
        F.min_by("symbol", worst).alias("worst_symbol"),
        F.round(F.min(r), 2).alias("worst_return_pct"),
        F.max("latest_date").alias("latest_date"),
    )


def return_ranking(snapshot: DataFrame) -> DataFrame:
    """Full ranking by return (desc, NULLs last), ties by symbol; distributed rank."""
    return global_rank(snapshot.select("symbol", "return_pct"),
                       [F.col("return_pct").desc_nulls_last(), F.col("symbol").asc()],
                       name="return_rank")


def freshness(silver: DataFrame) -> DataFrame:
    """Latest market date, symbol count, symbols with a bar on that date.

    Three small steps after one row per symbol: no distinct count, so no row is expanded."""
    latest = silver.groupBy("symbol").agg(F.max("price_date").alias("_d"))
    by_day = latest.groupBy("_d").agg(F.count("symbol").alias("_n"))
    return by_day.agg(
        F.max("_d").alias("latest_price_date"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_symbols"),
        F.coalesce(F.max_by("_n", "_d"), F.lit(0)).alias("symbols_at_latest_date"),
    )


def horizon_returns(silver: DataFrame) -> DataFrame:
    """One row per (symbol, horizon) with base and latest close and the return.

    1D / 1W use the lag-1 / lag-5 closes of the symbol's last row; 1M..5Y the last bar on
    or before ``add_months(ref, -n)``; YTD the last bar before January 1 of the ref year;
    MAX the first bar.
    """
    ref = reference_date(silver)
    # 1D / 1W bases = lag-1 / lag-5 of the last row = the 2nd / 6th latest close. A top-6
    # per symbol (limited per task before the shuffle) gives them without running the
    # lag window over every row.
    newest = Window.partitionBy("symbol").orderBy(F.col(PD).desc())
    recent = (silver.select("symbol", ADJ, F.row_number().over(newest).alias("_rd"))
              .where(F.col("_rd") <= 6)
              .groupBy("symbol").agg(F.max(F.when(F.col("_rd") == 2, F.col(ADJ))).alias("_b_1D"),
                                     F.max(F.when(F.col("_rd") == 6, F.col(ADJ))).alias("_b_1W")))
    bases = {
        "YTD": F.max_by(ADJ, F.when(F.col(PD) < F.trunc(ref, "year"), F.col(PD))),
        "MAX": F.min_by(ADJ, "price_date"),
    }
    for h, months in HORIZON_MONTHS.items():
        bases[h] = F.max_by(ADJ, _on_or_before(F.add_months(ref, -months)))
    wide = (silver.groupBy("symbol").agg(
        F.max("price_date").alias("latest_date"),
        F.max_by(ADJ, "price_date").alias("latest_adjusted_close"),
        *[e.alias(f"_b_{h}") for h, e in bases.items()],
    ).join(recent, "symbol", "left"))
    stacked = F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.lit(i).alias("horizon_order"), F.col(f"_b_{h}").alias("b"))
        for i, h in enumerate(HORIZONS)]))
    long = wide.select("symbol", "latest_date", "latest_adjusted_close", stacked.alias("_h"))
    return long.select(
        "symbol", F.col("_h.horizon").alias("horizon"), F.col("_h.horizon_order").alias("horizon_order"),
        "latest_date", "latest_adjusted_close", F.col("_h.b").alias("base_adjusted_close"),
        ratio_return_pct("latest_adjusted_close", "_h.b").alias("return_pct"))


def horizon_ranking(returns: DataFrame, horizon: str) -> DataFrame:
    """G11 for a selected horizon of ``horizon_returns``: rank by return (desc, NULLs last),
    ties by symbol, without a single-partition window."""
    rows = returns.where(F.col("horizon") == horizon).select("symbol", "horizon", "return_pct")
    return global_rank(rows, [F.col("return_pct").desc_nulls_last(), F.col("symbol").asc()],
                       name="return_rank")


def growth_of_100(silver: DataFrame, symbols: list[str] | None = None, months: int = 12,
                  horizon: str | None = None) -> DataFrame:
    """Each symbol's close scaled so its first bar on or after the window start is
    exactly 100. The start is ``add_months(ref, -months)``, or follows a dashboard
    ``horizon`` (1M..5Y as months, YTD = 1 January of the ref year, MAX = no bound).
    The per-symbol base is an aggregate joined back on symbol (AQE broadcasts it at
    runtime when it is small)."""
    ref = reference_date(silver)
    if horizon is None:
        start = F.add_months(ref, -months)
    elif horizon in HORIZON_MONTHS:
        start = F.add_months(ref, -HORIZON_MONTHS[horizon])
    elif horizon == "YTD":
        start = F.trunc(ref, "year")
    elif horizon == "MAX":
        start = None
    else:
        raise ValueError(f"growth_of_100 horizon must be one of {list(HORIZON_MONTHS)} + YTD, MAX")
    rows = silver if start is None else silver.where(F.col(PD) >= start)
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(list(symbols)))
    rows = rows.select("symbol", "price_date", ADJ)
    base = rows.groupBy("symbol").agg(F.min("price_date").alias("base_date"),
                                      F.min_by(ADJ, "price_date").alias("_base"))
    out = rows.join(base, "symbol")
    return out.select("symbol", "price_date", "base_date", ADJ,
                      F.when(F.col("_base") == 0, F.lit(None).cast("double"))
                      .otherwise(F.col(ADJ) * 100 / F.col("_base")).alias("growth_of_100"))
