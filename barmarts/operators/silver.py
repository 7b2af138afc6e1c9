"""G1: cleaned bars with trading-day ordinal and lagged returns.

Two physical forms with identical rows:

* ``silver(bronze, split_by=None)`` - one window partitioned by symbol (row_number,
  lag 1, lag 5 share one Window node). Each task holds one symbol's whole series.
* ``silver(bronze)`` (default ``split_by="month"``) - the window runs per (symbol, month) chunk and
  the first rows of each chunk take their lag-1 / lag-5 values from a 5-row halo of the
  preceding chunks. Parallelism is then bounded by symbols x months instead of symbols,
  so one symbol holding a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmarts.functions.returns import safe_return, safe_return_pct
from barmarts.schemas import SILVER_COLUMNS

LAGS = (1, 5)
# chunk units for the split form: finer units spread one symbol over more tasks
SPLIT_UNITS = ("week", "month", "quarter", "year")


def clean_bars(bronze: DataFrame) -> DataFrame:
    """F1 + F2 + P7: mandatory fields present, high >= low (NULL on either side drops)."""
    return bronze.where(
        F.col("symbol").isNotNull() & F.col("price_date").isNotNull()
        & F.col("adjusted_close").isNotNull() & F.col("volume").isNotNull()
        & (F.col("high") >= F.col("low"))
    ).select(
        "symbol", "price_date",
        F.col("open").alias("opening_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("closing_price"),
        F.col("adjusted_close").alias("adjusted_closing_price"),
        "volume", "source_provider",
        F.col("load_type").alias("data_loaded_as"),
        "batch_id", "ingested_at_utc",
    )


def _finish(df: DataFrame) -> DataFrame:
    adj, p1, p5 = "adjusted_closing_price", "previous_adjusted_closing_price", "adjusted_close_5d_ago"
    return df.select(
        *[c for c in SILVER_COLUMNS if c not in
          ("daily_return", "daily_return_pct", "return_5d", "return_5d_pct")],
        safe_return(adj, p1).alias("daily_return"),
        safe_return_pct(adj, p1).alias("daily_return_pct"),
        safe_return(adj, p5).alias("return_5d"),
        safe_return_pct(adj, p5).alias("return_5d_pct"),
    ).select(*SILVER_COLUMNS)


def silver(bronze: DataFrame, split_by: str | None = "month", audit: bool = False) -> DataFrame:
    src = clean_bars(bronze)
    if split_by is None:
        w = Window.partitionBy("symbol").orderBy("price_date")
        out = src.select(
            "*",
            F.row_number().over(w).alias("trading_day_number"),
            F.lag("adjusted_closing_price", 1).over(w).alias("previous_adjusted_closing_price"),
            F.lag("adjusted_closing_price", 5).over(w).alias("adjusted_close_5d_ago"),
        )
    elif split_by in SPLIT_UNITS:
        out = _chunked_lags(src, F.trunc("price_date", split_by))
    else:
        raise ValueError(f"split_by must be None or one of {SPLIT_UNITS}, got {split_by!r}")
    out = _finish(out)
    if audit:
        out = out.withColumn("silver_created_at_utc", F.current_timestamp())
    return out


def _chunked_lags(src: DataFrame, chunk_expr) -> DataFrame:
    """Lags per (symbol, chunk) plus a halo from earlier chunks: the full rows go through one
    window only, the chunk table through the others."""
    base = src.withColumn("_chunk", chunk_expr)
    return lag_rows(base, chunk_context(chunk_table(base))).select(*src.columns, *LAG_COLUMNS)


LAG_COLUMNS = ["trading_day_number", "previous_adjusted_closing_price", "adjusted_close_5d_ago"]


def chunk_table(base: DataFrame) -> DataFrame:
    """(symbol, _chunk) -> row count and the last closes, newest first (a chunk holds at most one
    bar a day, so a year's list has 366 entries at most)."""
    newest_first = F.reverse(F.array_sort(F.collect_list(F.struct("price_date", "adjusted_closing_price"))))
    return base.groupBy("symbol", "_chunk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.transform(F.slice(newest_first, 1, max(LAGS)), lambda x: x["adjusted_closing_price"]).alias("_tail"))


def chunk_context(chunks: DataFrame) -> DataFrame:
    """Each chunk's offset and the closes before it. As many chunks before as the longest lag
    suffice, as none is empty."""
    depth = max(LAGS)
    by_symbol = Window.partitionBy("symbol").orderBy("_chunk")
    before = chunks.select(
        "symbol", "_chunk",
        F.coalesce(F.sum("_n").over(by_symbol.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.slice(F.flatten(F.reverse(F.collect_list("_tail").over(by_symbol.rowsBetween(-depth, -1)))), 1, depth).alias("_halo"))
    # grouped by exactly the join keys, so Catalyst can drop the join when unused
    return before.groupBy("symbol", "_chunk").agg(F.max("_offset").alias("_offset"), F.first("_halo").alias("_halo"))


def lag_rows(base: DataFrame, before: DataFrame) -> DataFrame:
    """``base`` (clean bars with ``_chunk``) with ordinal and lags, given each chunk's context."""
    depth, adj = max(LAGS), "adjusted_closing_price"
    wc = Window.partitionBy("symbol", "_chunk").orderBy("price_date")
    rows = base.select(
        "*",
        F.row_number().over(wc).alias("_rn"),
        F.lag(adj, 1).over(wc).alias("_l1"),
        F.lag(adj, depth).over(wc).alias("_l5"),
    )
    # a left join: equal to inner here (every chunk has a row), and it lets Catalyst drop the
    # chunk branch when a consumer reads neither the lag columns nor the trading-day ordinal
    out = rows.join(before, ["symbol", "_chunk"], "left")
    return out.select(
        *base.columns,
        (F.col("_offset") + F.col("_rn")).cast("int").alias("trading_day_number"),
        F.when(F.col("_rn") > 1, F.col("_l1")).otherwise(
            F.get("_halo", F.lit(0))).alias("previous_adjusted_closing_price"),
        F.when(F.col("_rn") > depth, F.col("_l5")).otherwise(
            F.get("_halo", F.lit(depth) - F.col("_rn"))).alias("adjusted_close_5d_ago"),
    )
