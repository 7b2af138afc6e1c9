"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.session import shared_dir

# White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Workspace:
    """Written tables of one operator run, in the shared checkpoint folder.

    A written table cuts lineage: a lost executor re-reads files, not the whole job.
    ``drop`` removes tables that the returned DataFrame no longer needs.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_dir(spark, "llm", name)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            p.getFileSystem(conf).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Make the library importable in Python workers (once per session): its sources go to
    them as a zip file, so a session started without --py-files works as well."""
    sc = spark.sparkContext
    if getattr(sc, "_barmarts_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else the library itself came as a zip file
        path = os.path.join(tempfile.mkdtemp(prefix="barmarts-"), "barmarts_workers.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)
    sc._barmarts_shipped = True


def split_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in order; null and blank texts give []."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is (plain lower() where the text is ASCII)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; a null id falls in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def connected_components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component = least node.

    Alternating large-star and small-star steps. Each step is one min-aggregate and one
    join, written to the shared folder; a step count logarithmic in the longest chain
    suffices. Nothing but two checksum numbers reaches the driver.
    """
    both = edges.select("a", "b").where("a <> b")
    now = ws.store(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    mark, step = None, 0
    while True:
        # large star: every neighbour above u goes to the least node around u
        sym = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (sym.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: every neighbour at or below u, and u itself, go to the least of them
        below = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        low = below.groupBy("u").agg(F.min("v").alias("m"))
        small = (below.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        step += 1
        now = ws.store(small, f"{name}-{step}")
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        ws.drop(f"{name}-{step - 1}")
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))).distinct())
