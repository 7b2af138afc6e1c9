"""The five marts, in one-pass form (one aggregate per grain), plus the
self-join forms of G2/G3 kept as test twins.

One-pass form: ``min_by/max_by(value, date)`` inside a single ``groupBy`` replaces the
"find the min date, join back to fetch the value" pattern. Both give the same rows when
the key (symbol, price_date) is unique; with duplicate keys the join form fans out and
the one-pass form does not (run the key check first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmarts.functions.alerts import alert_message, alert_severity, alert_type
from barmarts.functions.returns import (change, count_when, is_flat, is_negative,
                                        is_positive, month_start, ratio_pct, ratio_return_pct)
from barmarts.schemas import (LONG_TERM_COLUMNS, MARKET_SUMMARY_COLUMNS, MOMENTUM_THRESHOLD,
                              MONTHLY_COLUMNS, RISK_COLUMNS, STRONG_THRESHOLD)

ADJ = "adjusted_closing_price"
PCT = "monthly_return_pct"


def _audit(df: DataFrame, audit: bool) -> DataFrame:
    return df.withColumn("gold_created_at_utc", F.current_timestamp()) if audit else df


# --- G2 ---------------------------------------------------------------------------------

def long_term_performance(silver: DataFrame, audit: bool = False) -> DataFrame:
    agg = silver.groupBy("symbol").agg(
        F.min("price_date").alias("start_date"),
        F.min_by(ADJ, "price_date").alias("first_adjusted_closing_price"),
        F.max("price_date").alias("end_date"),
        F.max_by(ADJ, "price_date").alias("latest_adjusted_closing_price"),
    )
    out = agg.select(
        "symbol", "start_date", "first_adjusted_closing_price", "end_date",
        "latest_adjusted_closing_price",
        change("latest_adjusted_closing_price", "first_adjusted_closing_price").alias("total_return"),
        ratio_return_pct("latest_adjusted_closing_price",
                         "first_adjusted_closing_price").alias("total_return_pct"),
    )
    return _audit(out.select(*LONG_TERM_COLUMNS), audit)


def long_term_performance_join_form(silver: DataFrame) -> DataFrame:
    src = silver.select("symbol", "price_date", ADJ)
    ends = src.groupBy("symbol").agg(F.min("price_date").alias("start_date"),
                                     F.max("price_date").alias("end_date")).alias("e")
    f, l = src.alias("f"), src.alias("l")
    first = ends.join(f, (F.col("f.symbol") == F.col("e.symbol"))
                      & (F.col("f.price_date") == F.col("e.start_date")))
    both = first.join(l, (F.col("l.symbol") == F.col("e.symbol"))
                      & (F.col("l.price_date") == F.col("e.end_date")))
    return both.select(
        F.col("e.symbol").alias("symbol"), F.col("e.start_date").alias("start_date"),
        F.col(f"f.{ADJ}").alias("first_adjusted_closing_price"), F.col("e.end_date").alias("end_date"),
        F.col(f"l.{ADJ}").alias("latest_adjusted_closing_price"),
        change(F.col(f"l.{ADJ}"), F.col(f"f.{ADJ}")).alias("total_return"),
        ratio_return_pct(F.col(f"l.{ADJ}"), F.col(f"f.{ADJ}")).alias("total_return_pct"),
    )


# --- G3 ---------------------------------------------------------------------------------

def monthly_performance(silver: DataFrame, audit: bool = False, ordered: bool = False) -> DataFrame:
    agg = (silver.select("symbol", "price_date", ADJ,
                         month_start("price_date").alias("month_start_date"))
           .groupBy("symbol", "month_start_date").agg(
               F.min("price_date").alias("first_trading_date_of_month"),
               F.max("price_date").alias("last_trading_date_of_month"),
               F.min_by(ADJ, "price_date").alias("first_adjusted_closing_price"),
               F.max_by(ADJ, "price_date").alias("last_adjusted_closing_price"),
               F.count(F.lit(1)).alias("trading_days_count"),
           ))
    out = agg.select(
        "symbol", "month_start_date", "first_trading_date_of_month", "last_trading_date_of_month",
        "first_adjusted_closing_price", "last_adjusted_closing_price",
        change("last_adjusted_closing_price", "first_adjusted_closing_price").alias("monthly_return"),
        ratio_return_pct("last_adjusted_closing_price",
                         "first_adjusted_closing_price").alias(PCT),
        "trading_days_count",
    ).select(*MONTHLY_COLUMNS)
    if ordered:  # O1: presentation order only (range-partitioned sort, no single task)
        out = out.orderBy("symbol", "month_start_date")
    return _audit(out, audit)


def monthly_performance_join_form(silver: DataFrame) -> DataFrame:
    def src():
        return silver.select("symbol", "price_date", ADJ,
                             month_start("price_date").alias("month_start_date"))
    s0 = src()
    dates = s0.groupBy("symbol", "month_start_date").agg(
        F.min("price_date").alias("first_trading_date_of_month"),
        F.max("price_date").alias("last_trading_date_of_month"))
    s1 = src()
    d1 = dates.select(F.col("symbol").alias("_s"), F.col("month_start_date").alias("_m"),
                      "first_trading_date_of_month")
    first = s1.join(d1, (s1.symbol == d1._s) & (s1.month_start_date == d1._m)
                    & (s1.price_date == d1.first_trading_date_of_month)) \
        .select(s1.symbol, s1.month_start_date, "first_trading_date_of_month",
                s1[ADJ].alias("first_adjusted_closing_price"))
    s2 = src()
    d2 = dates.select(F.col("symbol").alias("_s"), F.col("month_start_date").alias("_m"),
                      "last_trading_date_of_month")
    last = s2.join(d2, (s2.symbol == d2._s) & (s2.month_start_date == d2._m)
                   & (s2.price_date == d2.last_trading_date_of_month)) \
        .select(s2.symbol.alias("_ls"), s2.month_start_date.alias("_lm"), "last_trading_date_of_month",
                s2[ADJ].alias("last_adjusted_closing_price"))
    days = src().groupBy("symbol", "month_start_date").agg(
        F.count(F.lit(1)).alias("trading_days_count")) \
        .select(F.col("symbol").alias("_ts"), F.col("month_start_date").alias("_tm"),
                "trading_days_count")
    j = (first.join(last, (first.symbol == last._ls) & (first.month_start_date == last._lm))
         .join(days, (first.symbol == days._ts) & (first.month_start_date == days._tm)))
    return j.select(
        "symbol", "month_start_date", "first_trading_date_of_month", "last_trading_date_of_month",
        "first_adjusted_closing_price", "last_adjusted_closing_price",
        change("last_adjusted_closing_price", "first_adjusted_closing_price").alias("monthly_return"),
        ratio_return_pct("last_adjusted_closing_price",
                         "first_adjusted_closing_price").alias(PCT),
        "trading_days_count",
    )


# --- G4 ---------------------------------------------------------------------------------

def _best_key(pct):
    """ORDER BY pct DESC (NULLs last), symbol ASC, as a struct for min_by.
    Spark orders NaN above every number, so DESC puts NaN first: the second field does."""
    return F.struct(pct.isNull().alias("n"), (~F.isnan(pct)).alias("nan"), (-pct).alias("v"),
                    F.col("symbol").alias("s"))


def _worst_key(pct):
    """ORDER BY pct ASC (NULLs first, Spark's default), symbol ASC."""
    return F.struct(pct.isNotNull().alias("n"), pct.alias("v"), F.col("symbol").alias("s"))


def monthly_market_summary(monthly: DataFrame, audit: bool = False) -> DataFrame:
    """Breadth, leaders and laggards per month in one aggregate (no rank windows, no joins)."""
    pct = F.col(PCT)
    agg = monthly.groupBy("month_start_date").agg(
        F.count(F.lit(1)).alias("total_etfs_count"),
        count_when(is_positive(pct)).alias("positive_etfs_count"),
        count_when(is_negative(pct)).alias("negative_etfs_count"),
        count_when(is_flat(pct)).alias("flat_etfs_count"),
        F.round(F.avg(pct), 2).alias("avg_monthly_return_pct"),
        F.round(F.max(pct), 2).alias("best_monthly_return_pct"),
        F.round(F.min(pct), 2).alias("worst_monthly_return_pct"),
        F.min_by(F.struct(F.col("symbol").alias("s"), pct.alias("p")), _best_key(pct)).alias("_b"),
        F.min_by(F.struct(F.col("symbol").alias("s"), pct.alias("p")), _worst_key(pct)).alias("_w"),
    )
    out = agg.select(
        "month_start_date", "total_etfs_count", "positive_etfs_count", "negative_etfs_count",
        "flat_etfs_count", "avg_monthly_return_pct", "best_monthly_return_pct",
        "worst_monthly_return_pct",
        F.col("_b.s").alias("best_performing_etf"),
        F.round("_b.p", 2).alias("best_performing_etf_return_pct"),
        F.col("_w.s").alias("worst_performing_etf"),
        F.round("_w.p", 2).alias("worst_performing_etf_return_pct"),
        ratio_pct(F.col("positive_etfs_count"), F.col("total_etfs_count")).alias("positive_etf_ratio_pct"),
    )
    return _audit(out.select(*MARKET_SUMMARY_COLUMNS), audit)


def top_k_per_month(monthly: DataFrame, k: int = 3, best: bool = True) -> DataFrame:
    """The k leaders (or laggards) per month; ties by symbol ascending.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so each map task ships at most k rows per month.
    """
    pct = F.col(PCT)
    order = [pct.desc_nulls_last(), F.col("symbol").asc()] if best else \
        [pct.asc_nulls_first(), F.col("symbol").asc()]
    w = Window.partitionBy("month_start_date").orderBy(*order)
    return (monthly.select("month_start_date", "symbol", PCT, F.row_number().over(w).alias("rank_in_month"))
            .where(F.col("rank_in_month") <= k)
            .select("month_start_date", "rank_in_month", "symbol",
                    F.round(pct, 2).alias(PCT)))


# --- G5 ---------------------------------------------------------------------------------

def risk_summary(monthly: DataFrame, audit: bool = False) -> DataFrame:
    pct = F.col(PCT)
    agg = monthly.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_months_count"),
        count_when(is_positive(pct)).alias("positive_months_count"),
        count_when(is_negative(pct)).alias("negative_months_count"),
        count_when(is_flat(pct)).alias("flat_months_count"),
        F.round(F.avg(pct), 2).alias("avg_monthly_return_pct"),
        F.round(F.max(pct), 2).alias("best_monthly_return_pct"),
        F.round(F.min(pct), 2).alias("worst_monthly_return_pct"),
        F.round(F.stddev_samp(pct), 2).alias("monthly_volatility_pct"),
    )
    vol = F.col("monthly_volatility_pct")
    out = agg.select(
        "*",
        ratio_pct(F.col("positive_months_count"), F.col("total_months_count")).alias("positive_month_ratio_pct"),
        # divides the already rounded average by the already rounded volatility
        F.when(vol.isNull() | (vol == 0), F.lit(None).cast("double")).otherwise(
            F.round(F.col("avg_monthly_return_pct") / vol, 2)).alias("return_to_risk_score"),
    )
    return _audit(out.select(*RISK_COLUMNS), audit)


# --- G6 ---------------------------------------------------------------------------------

def alert_candidates(monthly: DataFrame, strong: float = STRONG_THRESHOLD,
                     momentum: float = MOMENTUM_THRESHOLD, audit: bool = False,
                     ordered: bool = False) -> DataFrame:
    pct = F.col(PCT)
    rules = monthly.select("symbol", "month_start_date", PCT,
                           alert_type(pct, strong, momentum).alias("alert_type"),
                           alert_severity(pct, strong, momentum).alias("alert_severity"))
    shown = F.round(pct, 2)
    out = rules.where(F.col("alert_type").isNotNull()).select(
        "symbol", "month_start_date", shown.alias(PCT), "alert_type", "alert_severity",
        alert_message(F.col("symbol"), F.col("alert_type"), F.col("month_start_date"),
                      shown).alias("alert_message"),
    )
    if ordered:  # O2
        out = out.orderBy(F.col("month_start_date").desc())
    return _audit(out, audit)
