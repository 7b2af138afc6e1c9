"""Landed CSV trees, consolidated files, materialised tables,
dimension and universe frames.

Landing layout (Hive-style): ``symbol=<s>/load_type=<t>[/price_date=<d>]/part-*.csv``.
Spark's partitioned writer keeps the partition columns in the path only; other trees
carry every column in the file as well (one ``prices.csv`` per leaf). The reader looks at
the header: columns in the files are read by name, missing key columns come from the path.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmarts.operators.normalise import MALFORMED, normalise_name
from barmarts.schemas import BRONZE, BRONZE_COLUMNS, DEFAULT_UNIVERSE

HISTORICAL_PARTITIONS = ["symbol", "load_type"]
INCREMENTAL_PARTITIONS = ["symbol", "load_type", "price_date"]


def write_landing(df: DataFrame, root: str, load_type: str = "historical") -> None:
    """Partitioned CSV; re-running replaces only the partitions it writes."""
    parts = INCREMENTAL_PARTITIONS if load_type == "incremental" else HISTORICAL_PARTITIONS
    # REBALANCE on the partition columns: few files per folder, AQE splits a hot symbol
    (df.select(*BRONZE_COLUMNS).hint("rebalance", *parts).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("header", True)
     .partitionBy(*parts).csv(root))


def _header(spark: SparkSession, root: str) -> list[str]:
    """Column names in the first line of a landed file; a tree without files raises (Q14)."""
    try:
        first = spark.read.option("recursiveFileLookup", True).text(root).first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no landed files under {root}") from e
    if first is None:
        raise FileNotFoundError(f"no landed files under {root}")
    return [h.strip().strip('"') for h in first[0].split(",")]


def _path_key(name: str) -> Column:
    """Value of ``name=<value>`` in a file's path, as text (never read as a number)."""
    raw = F.regexp_extract(F.col("_metadata.file_path"), f"/{name}=([^/]*)/", 1)
    for _ in range(2):  # folder names are escaped once, the file's URI once more
        raw = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != "", raw)


def _required_key(name: str) -> Column:
    """The path key; a file whose path lacks it stops the read and is named."""
    key = _path_key(name)
    return F.when(key.isNotNull(), key).otherwise(
        F.raise_error(F.concat(F.lit(f"no column and no folder {name}=<value> for "), F.col("_metadata.file_path"))).cast("string"))


def _read_strings(spark: SparkSession, root: str, malformed: bool = False) -> DataFrame:
    """All landed files as text columns, matched to the header: a file whose header differs
    from the others' (names or order) is refused instead of read by position. With
    ``malformed`` the text of lines that do not fit the header is kept in a column of its own."""
    reader = (spark.read.option("header", True).option("enforceSchema", False)
              .option("recursiveFileLookup", True))
    if not malformed:
        return reader.option("inferSchema", False).csv(root)
    names = reader.option("inferSchema", False).csv(root).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(root)


def read_landing(spark: SparkSession, root: str, layout: str = "auto") -> DataFrame:
    """S3: one distributed read of the whole tree, typed under ANSI (a bad value raises).

    Columns are taken by header name. Key columns that the files do not carry come from the
    path (``layout="partitioned"``); with ``"files"`` every column must be in the files;
    ``"auto"`` decides by the header."""
    header = _header(spark, root)
    if layout == "files":
        missing = [c for c in BRONZE_COLUMNS if c not in header]
        if missing:
            raise ValueError(f"landed files lack columns: {missing}")
    absent = [c for c in BRONZE_COLUMNS if c not in header and c not in INCREMENTAL_PARTITIONS]
    if absent:
        raise ValueError(f"landed files lack columns: {absent}")
    df = _read_strings(spark, root)
    cols = []
    for f in BRONZE.fields:
        if f.name in header and not (layout == "partitioned" and f.name in INCREMENTAL_PARTITIONS and f.name not in df.columns):
            raw = F.col(f.name)
        else:
            raw = _required_key(f.name)
        cols.append(raw.cast("decimal(38,10)").cast("bigint") if f.name == "volume" else raw.cast(f.dataType))
    return df.select(*[c.alias(f.name) for c, f in zip(cols, BRONZE.fields)])


def read_vendor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw vendor CSV with its own headers, all columns as strings (normalised by P1-P6);
    ``symbol`` comes from the landing path where the files do not carry it. Lines that do not fit
    the header come along with their text and file, to be rejected (never read as NULLs)."""
    df = _read_strings(spark, path, malformed=True)
    where = F.concat_ws(": ", "_metadata.file_path", F.col(MALFORMED))
    df = df.withColumn(MALFORMED, F.when(F.col(MALFORMED).isNotNull(), where))
    if any(normalise_name(c) == "symbol" for c in df.columns):
        return df
    return df.withColumn("symbol", _path_key("symbol"))


def consolidate(spark: SparkSession, root: str, out: str, layout: str = "auto") -> DataFrame:
    """All per-symbol files -> one dataset (a folder of part files), refusing duplicates."""
    from barmarts.operators.quality import enforce_gates
    df = read_landing(spark, root, layout)
    enforce_gates(df, required=None)
    df.write.mode("overwrite").option("header", True).csv(out)
    return read_landing(spark, out, layout="files")


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", sort_by: list[str] | None = None) -> DataFrame:
    """Replace a table at ``path`` whole (static overwrite, also when partitioned);
    returns a DataFrame over what was written. ``sort_by`` orders rows inside each write task
    (storage order for O1: tight row-group min/max stats, no global sort)."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return df.sparkSession.read.format(fmt).load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """S7."""
    df.createOrReplaceTempView(name)
    return df


DIMENSION_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("asset_class", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
])


def read_dimension(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Symbol dimension file (JSON lines or CSV with a header)."""
    reader = spark.read.schema(DIMENSION_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def universe_frame(spark: SparkSession, symbols: list[str] | None = None) -> DataFrame:
    """The configured symbol universe as a one-column frame."""
    rows = [(s,) for s in (symbols if symbols is not None else DEFAULT_UNIVERSE)]
    return spark.createDataFrame(rows, "symbol string")
