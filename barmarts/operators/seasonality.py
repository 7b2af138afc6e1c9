"""Calendar-month seasonality over the month-by-month mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmarts.functions.returns import ratio_pct

PCT = "monthly_return_pct"
MONTHS = list(range(1, 13))


def _since(monthly: DataFrame, since: str | None) -> DataFrame:
    return monthly if since is None else monthly.where(F.col("month_start_date") >= F.to_date(F.lit(since)))


def seasonality_heatmap(monthly: DataFrame, since: str | None = None) -> DataFrame:
    """Symbol x calendar month, mean monthly pct rounded to 2 (columns m01..m12),
    over months from ``since`` on (all history by default).

    The pivot values are given, so Spark plans one aggregate without a distinct pass.
    """
    piv = (_since(monthly, since).select("symbol", F.month("month_start_date").alias("cal_month"), PCT)
           .groupBy("symbol").pivot("cal_month", MONTHS).agg(F.round(F.avg(PCT), 2)))
    return piv.select("symbol", *[F.col(str(m)).alias(f"m{m:02d}") for m in MONTHS])


def seasonality_by_month(monthly: DataFrame, since: str | None = None) -> DataFrame:
    pct = F.col(PCT)
    return (_since(monthly, since).select(F.month("month_start_date").alias("calendar_month"), PCT)
            .groupBy("calendar_month").agg(
                F.count(pct).alias("observations"),
                F.round(F.avg(pct), 2).alias("avg_return_pct"),
                ratio_pct(F.sum(F.when(pct > 0, 1).otherwise(0)), F.count(pct)).alias("positive_ratio_pct")))


def seasonality_leaders(monthly: DataFrame, since: str | None = None) -> DataFrame:
    """Per calendar month stats with the three leader flags (ties -> lowest month).

    The picks run over the 12 calendar-month rows (a fixed bound), so an unpartitioned
    window over them is one tiny task after the aggregate has combined the data.
    """
    stats = seasonality_by_month(monthly, since)
    m, a, p = F.col("calendar_month"), F.col("avg_return_pct"), F.col("positive_ratio_pct")
    all12 = Window.partitionBy()
    return stats.select(
        "*",
        (m == F.min_by(m, F.struct(-a, m)).over(all12)).alias("is_highest_average"),
        (m == F.min_by(m, F.struct(a, m)).over(all12)).alias("is_lowest_average"),
        (m == F.min_by(m, F.struct(-p, m)).over(all12)).alias("is_most_often_positive"))
