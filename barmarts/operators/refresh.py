"""G1 after an upsert: Silver brought up to date from the chunks that changed.

Silver's rows depend on their own (symbol, month) chunk, on the number of rows before it and on the
five closes before it. All that is in the chunk table, which is stored beside Silver (one row
per symbol and month). After an upsert the touched chunks are counted anew; comparing the old
context of every chunk with the new one gives the chunks whose offset or halo changed as well.
Only those are computed from Bronze; all other rows of Silver are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmarts.operators.silver import _finish, chunk_context, chunk_table, clean_bars, lag_rows

CHUNK = ["symbol", "_chunk"]


def month_chunks(bronze: DataFrame) -> DataFrame:
    """The chunk table of a whole Bronze table."""
    return chunk_table(clean_bars(bronze).withColumn("_chunk", F.trunc("price_date", "month")))


def touched_chunks(batch: DataFrame) -> DataFrame:
    return batch.select("symbol", F.trunc("price_date", "month").alias("_chunk")).distinct()


def refreshed_chunks(chunks: DataFrame, touched: DataFrame, touched_bars: DataFrame) -> DataFrame:
    """The chunk table after an upsert; ``touched_bars``: Bronze, at least in the touched chunks."""
    bars = touched_bars.withColumn("_chunk", F.trunc("price_date", "month")).join(touched, CHUNK, "left_semi").drop("_chunk")
    return chunks.join(touched, CHUNK, "left_anti").unionByName(month_chunks(bars))


def changed_chunks(before: DataFrame, after: DataFrame, touched: DataFrame) -> DataFrame:
    """Chunks of the table ``after`` whose bars (``touched``), offset or halo differ from ``before``."""
    was = chunk_context(before).select(*CHUNK, F.col("_offset").alias("_was_offset"), F.col("_halo").alias("_was_halo"))
    moved = (chunk_context(after).join(was, CHUNK, "left")
             .where(~F.col("_offset").eqNullSafe(F.col("_was_offset")) | ~F.col("_halo").eqNullSafe(F.col("_was_halo"))))
    return moved.select(*CHUNK).unionByName(touched).distinct()


def refresh_silver(silver: DataFrame, changed: DataFrame, bars: DataFrame, chunks: DataFrame) -> DataFrame:
    """``silver`` with the ``changed`` chunks computed anew. ``bars``: Bronze after the upsert, at
    least in the changed chunks; ``chunks``: the chunk table after the upsert."""
    kept = (silver.withColumn("_chunk", F.trunc("price_date", "month")).join(changed, CHUNK, "left_anti").drop("_chunk"))
    base = clean_bars(bars).withColumn("_chunk", F.trunc("price_date", "month")).join(changed, CHUNK, "left_semi")
    return kept.unionByName(_finish(lag_rows(base, chunk_context(chunks))))
