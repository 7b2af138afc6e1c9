"""F5 and Q13 as streams: state that lives in the state store across micro-batches and restarts.

* ``newest_bars``: the newest bar of each symbol, one state row per symbol, updated by whatever
  file brings a newer one. Late and repeated files change nothing.
* ``closed_days``: how many symbols each day has. A day waits ``delay`` for late files: it closes
  when the watermark (latest date seen less ``delay``) passes its end, which also frees its state.
  Copies of a bar count once (de-duplicated within the same watermark). Rows of days that
  are closed are too late to count; the query's progress reports them as dropped by the watermark.

Both write each micro-batch to a folder of its own, replaced when the micro-batch is replayed, so
the output does not depend on failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barmarts.schemas import BRONZE_COLUMNS
from barmarts.streaming.ingest import landed_stream


def newest_bars(bars: DataFrame) -> DataFrame:
    """One row per symbol: the greatest bar by date (of several bars of the newest day, the greatest
    by the remaining columns, so that the result does not depend on the order of files)."""
    rest = [c for c in BRONZE_COLUMNS if c not in ("symbol", "price_date")]
    newest = bars.groupBy("symbol").agg(F.max(F.struct("price_date", *rest)).alias("bar"))
    return newest.select("symbol", "bar.*").select(*BRONZE_COLUMNS)


def closed_days(bars: DataFrame, delay: str) -> DataFrame:
    """(price_date, n_symbols) of the days that have closed."""
    stamped = bars.select("symbol", F.col("price_date").cast("timestamp").alias("at")).withWatermark("at", delay)
    once = stamped.dropDuplicates(["symbol", "at"])
    return (once.groupBy(F.window("at", "1 day").alias("day")).agg(F.count(F.lit(1)).alias("n_symbols"))
            .select(F.col("day.start").cast("date").alias("price_date"), "n_symbols"))


def _start(out: DataFrame, mode: str, path: str, checkpoint: str) -> StreamingQuery:
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return (out.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _finish(query: StreamingQuery) -> list[dict]:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return [dict(p) if isinstance(p, dict) else p for p in query.recentProgress]


def run_newest_bars(spark: SparkSession, landing: str, out: str, checkpoint: str, max_files: int | None = None) -> DataFrame:
    """Take the files landed since the last run; the newest bar of each symbol so far."""
    _finish(_start(newest_bars(landed_stream(spark, landing, max_files)), "update", f"{out}/rows", checkpoint))
    rows = spark.read.parquet(f"{out}/rows")
    # every micro-batch holds the symbols that it changed; the last one to hold a symbol counts
    latest = Window.partitionBy("symbol").orderBy(F.col("batch").desc())
    return rows.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").select(*BRONZE_COLUMNS)


def run_closed_days(spark: SparkSession, landing: str, out: str, checkpoint: str, delay: str, symbols: int,
                    max_files: int | None = None) -> DataFrame:
    """Take the files landed since the last run; (price_date, n_symbols, n_missing) of all days that
    have closed so far, against a universe of ``symbols`` (Q13 by day)."""
    _finish(_start(closed_days(landed_stream(spark, landing, max_files), delay), "append", f"{out}/rows", checkpoint))
    return spark.read.parquet(f"{out}/rows").select("price_date", "n_symbols", (F.lit(symbols) - F.col("n_symbols")).cast("long").alias("n_missing"))
