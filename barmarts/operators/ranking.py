"""Ranks without a single-partition window.

``global_rank`` numbers rows 1..N in a total order: rows are range-partitioned on the
order keys (balanced by sampling), numbered inside each range, and written once with their
range number to the shared folder. The row counts of the ranges and the ranks both come
from that table, so they always speak of the same ranges, and the input is computed once.
The only global step runs on one row per range (bounded by the shuffle partition count),
which is also why broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmarts.session import shared_dir


def global_rank(df: DataFrame, order: list[Column], name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    numbered = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    path = shared_dir(spark, "ranked")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    sizes = stored.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return (stored.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("int"))
            .drop("_pid", "_rn", "_off"))
