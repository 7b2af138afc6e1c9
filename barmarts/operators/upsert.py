"""Idempotent upsert by (symbol, price_date).

Matched keys take every column of the batch (lineage included); unmatched batch rows
are inserted. Parquet tables have no row-level MERGE, so the primary form is
``target LEFT ANTI JOIN batch_keys UNION ALL batch``. ``merge_into`` emits the MERGE
statement for catalogs whose tables support it.

``upsert_into_path`` keeps Bronze as Parquet folders by month, for one writer at a time. It
merges the months of the batch with their current folders into a new version folder and then
replaces one small pointer file (month -> folder) by an atomic rename. Readers that come before
see the old rows, later ones the new; a stop in between leaves the table as it was. Months that
the batch does not touch keep their folders, and folders replaced by the update before are
removed, so a reader has until the next update. Two concurrent writers are refused where the
second sees the pointer change; tables that several jobs write belong in a catalog with
row-level operations (``merge_into``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.schemas import BRONZE, BRONZE_COLUMNS, KEY
from barmarts.session import shared_dir

MONTH = "price_month"
POINTER = "CURRENT.json"


def upsert(target: DataFrame, batch: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``, plus all of ``batch``."""
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def merge_sql(target_table: str, source_view: str, keys: list[str] = KEY) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (f"MERGE INTO {target_table} AS t USING {source_view} AS s ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def merge_into(spark: SparkSession, target_table: str, batch: DataFrame,
               keys: list[str] = KEY, view: str = "barmarts_landing") -> None:
    """MERGE for tables with row-level operations (raises on plain parquet tables)."""
    batch.createOrReplaceTempView(view)
    spark.sql(merge_sql(target_table, view, keys))


def create_bucketed(df: DataFrame, name: str, buckets: int, path: str, keys: list[str] = KEY) -> DataFrame:
    """Store ``df`` as a catalog table whose rows are dealt to ``buckets`` by key and sorted, so that
    upserts and joins on the key find the target where it is (J9 without shuffling the target).
    ``buckets`` should be at least the session's shuffle partitions."""
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("price_date", "yyyy-MM"))


def _by_month(df: DataFrame) -> DataFrame:
    """Rows of one month go to few writer tasks (few files per partition folder); AQE
    splits a month that is too large and merges small ones (REBALANCE). Sorting inside
    each task by key (O3) gives tight row-group min/max stats for symbol/date pushdown."""
    return df.hint("rebalance", MONTH).sortWithinPartitions(MONTH, *KEY)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_pointer(spark: SparkSession, path: str) -> dict:
    """months: month -> folder; streams: stream -> last batch written; retired: folders that the
    last update replaced. Empty for a new table."""
    p, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return {"months": {}, "streams": {}, "retired": []}
    return json.loads(spark.read.option("wholetext", True).text(f"{path}/{POINTER}").first()[0])


def _replace_pointer(spark: SparkSession, path: str, pointer: dict) -> None:
    """Write the pointer beside and rename it over the old one (atomic on HDFS and local disks)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own, fs = _fs(spark, f"{path}/.{uuid.uuid4().hex}.json")
    out = fs.create(own, True)
    out.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    out.close()
    own, final = fs.makeQualified(own), fs.makeQualified(_fs(spark, f"{path}/{POINTER}")[0])
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(own, final, overwrite)


def _read_months(spark: SparkSession, path: str, months: dict[str, str]) -> DataFrame:
    if not months:
        return spark.createDataFrame([], BRONZE)
    return (spark.read.schema(BRONZE).option("recursiveFileLookup", True)
            .parquet(*[f"{path}/{folder}/{MONTH}={m}" for m, folder in sorted(months.items())]).select(*BRONZE_COLUMNS))


def read_bronze(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The current rows of the table at ``path`` (a plain Parquet folder is read as it is); with
    ``only``, the folders of those months (yyyy-MM) are read."""
    months = read_pointer(spark, path)["months"]
    if only is not None:
        return _read_months(spark, path, {m: months[m] for m in only if m in months})
    return _read_months(spark, path, months) if months else spark.read.parquet(path).select(*BRONZE_COLUMNS)


def upsert_into_path(spark: SparkSession, path: str, batch: DataFrame, keys: list[str] = KEY,
                     token: tuple[str, int] | None = None) -> DataFrame:
    """Upsert ``batch`` into the table at ``path`` and return its new state.

    ``token``: (stream, batch number) of a replayable unit of work; one that the pointer already
    holds is skipped, so a replay after other updates neither loses nor reverts a row. Only the
    batch's months (bounded by the calendar) are listed on the driver.
    """
    before = read_pointer(spark, path)
    if token is not None and before["streams"].get(token[0], -1) >= token[1]:
        return read_bronze(spark, path)
    stored = shared_dir(spark, "upsert-batch")
    _with_month(batch.select(*BRONZE_COLUMNS)).write.parquet(stored)
    batch = spark.read.parquet(stored)
    touched = [r[0] for r in batch.select(MONTH).distinct().collect()]
    current = _read_months(spark, path, {m: before["months"][m] for m in touched if m in before["months"]})
    version = f"v-{uuid.uuid4().hex}"
    merged = upsert(current, batch.select(*BRONZE_COLUMNS), keys)
    _by_month(_with_month(merged)).write.partitionBy(MONTH).parquet(f"{path}/{version}")
    if read_pointer(spark, path) != before:
        raise RuntimeError(f"another writer changed {path}; this table takes one writer at a time")
    _replace_pointer(spark, path, {
        "months": {**before["months"], **dict.fromkeys(touched, version)},
        "streams": {**before["streams"], **(dict([token]) if token is not None else {})},
        "retired": [f"{before['months'][m]}/{MONTH}={m}" for m in touched if m in before["months"]]})
    for old in [stored, *(f"{path}/{folder}" for folder in before["retired"])]:
        p, fs = _fs(spark, old)
        fs.delete(p, True)
    return read_bronze(spark, path)
