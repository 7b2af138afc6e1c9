"""A6, A7, G5 and A10 from stored parts, so that new months do not read old ones again.

``risk_parts`` keeps count, mean and second moment (M2), extremes and sign counts of the monthly
returns per symbol and year; ``risk_from_parts`` merges parts pairwise (Chan's rule, which does
not cancel as sums of squares do). ``month_sketches`` keeps one HyperLogLog sketch of the symbols
per month; ``profile_from_sketches`` merges them. Both kinds of part can be appended and merged
in any order. A symbol has one part per year, so the merged list is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.functions.returns import ratio_pct

#: log2 of a sketch's registers; the relative standard error is 1.04 / sqrt(2 ** LG).
LG = 12
STANDARD_ERROR = 1.04 / (1 << LG) ** 0.5


def risk_parts(monthly: DataFrame, pct: str = "monthly_return_pct") -> DataFrame:
    """(symbol, year) -> months, n (months with a return), mean, m2, best, worst, positive, negative, flat."""
    p = F.col(pct)
    return monthly.groupBy("symbol", F.year("month_start_date").alias("year")).agg(
        F.count(F.lit(1)).alias("months"), F.count(p).alias("n"), F.avg(p).alias("mean"),
        (F.var_pop(p) * F.count(p)).alias("m2"), F.max(p).alias("best"), F.min(p).alias("worst"),
        F.count_if(p > 0).alias("positive"), F.count_if(p < 0).alias("negative"), F.count_if(p == 0).alias("flat"))


def _merge(a: Column, b: Column) -> Column:
    n = a["n"] + b["n"]
    delta, share = b["mean"] - a["mean"], b["n"] / F.greatest(n, F.lit(1))
    both = F.struct(n.alias("n"), (a["mean"] + delta * share).alias("mean"),
                    (a["m2"] + b["m2"] + delta * delta * a["n"] * share).alias("m2"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def risk_from_parts(parts: DataFrame) -> DataFrame:
    """The risk summary (G5) of all parts; equal to the one over the months themselves."""
    moment = F.struct(F.col("n").cast("long").alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    grouped = parts.groupBy("symbol").agg(
        F.sum("months").alias("total_months_count"), F.sum("positive").alias("positive_months_count"),
        F.sum("negative").alias("negative_months_count"), F.sum("flat").alias("flat_months_count"),
        F.round(F.max("best"), 2).alias("best_monthly_return_pct"), F.round(F.min("worst"), 2).alias("worst_monthly_return_pct"),
        F.sort_array(F.collect_list(F.struct("year", moment.alias("x")))).alias("parts"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    merged = grouped.withColumn("all", F.aggregate(F.transform("parts", lambda p: p["x"]), zero, _merge))
    n = F.col("all")["n"]
    rounded = merged.withColumns({
        "avg_monthly_return_pct": F.round(F.when(n > 0, F.col("all")["mean"]), 2),
        "monthly_volatility_pct": F.round(F.when(n > 1, F.sqrt(F.col("all")["m2"] / (n - 1))), 2),
        "positive_month_ratio_pct": ratio_pct(F.col("positive_months_count"), F.col("total_months_count"))})
    volatility = F.col("monthly_volatility_pct")
    return rounded.select(
        "symbol", "total_months_count", "positive_months_count", "negative_months_count", "flat_months_count", "avg_monthly_return_pct",
        "best_monthly_return_pct", "worst_monthly_return_pct", "monthly_volatility_pct", "positive_month_ratio_pct",
        F.when(volatility.isNull() | (volatility == 0), None).otherwise(F.round(F.col("avg_monthly_return_pct") / volatility, 2)).alias("return_to_risk_score"))


def month_sketches(bars: DataFrame, symbol: str = "symbol", date: str = "price_date") -> DataFrame:
    """month -> rows, first and last date, sketch of the symbols (fixed size)."""
    return bars.groupBy(F.trunc(date, "month").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first"), F.max(date).alias("last"), F.hll_sketch_agg(symbol, LG).alias("symbols"))


def profile_from_sketches(sketches: DataFrame) -> DataFrame:
    """A10 from stored months; ``about_symbols`` is the estimate of the merged sketch."""
    return sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.hll_sketch_estimate(F.hll_union_agg("symbols")).alias("about_symbols"),
                        F.min("first").alias("earliest_date"), F.max("last").alias("latest_date"))
