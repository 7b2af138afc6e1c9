"""O1 / S6 as storage: tables kept in ranges of their keys.

``write_clustered`` deals rows to files by ranges of the sort columns (balanced by sampling, a
hot symbol spans several files) and sorts inside each file. The least and greatest key of each
file are kept beside the table, so a query with bounds opens only the files whose zone it meets;
inside them, row-group statistics go on pruning.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: More files than this are not listed one by one: the table is read whole, with the same filter.
MAX_LISTED = 10_000
ZONES = "_zones"  # the underscore keeps it out of the table


def write_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in about ``files`` ranges of ``by``."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    bounds = [f(c).alias(f"{name}_{c}") for c in by for name, f in (("least", F.min), ("most", F.max))]
    (stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bounds, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(f"{path}/{ZONES}"))
    return stored


def zones(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``file``, ``least_<key>``, ``most_<key>``, ``rows``."""
    return spark.read.parquet(f"{path}/{ZONES}")


def read_clustered(spark: SparkSession, path: str, **bounds: tuple[Any, Any]) -> DataFrame:
    """Rows whose keys lie within the closed ``bounds`` (column=(low, high)); None leaves a side
    open. Only the names of the files that may hold such rows reach the driver."""
    meets, inside = F.lit(True), F.lit(True)
    for column, (low, high) in bounds.items():
        if low is not None:
            meets, inside = meets & (F.col(f"most_{column}") >= F.lit(low)), inside & (F.col(column) >= F.lit(low))
        if high is not None:
            meets, inside = meets & (F.col(f"least_{column}") <= F.lit(high)), inside & (F.col(column) <= F.lit(high))
    files = [r.file for r in zones(spark, path).where(meets).select("file").limit(MAX_LISTED + 1).collect()]
    table = spark.read.parquet(path)
    if len(files) <= MAX_LISTED:
        table = spark.read.schema(table.schema).parquet(*files) if files else table.where(F.lit(False))
    return table.where(inside)
