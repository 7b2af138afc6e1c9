"""Session construction and the shared working folder.

Work that must survive executor loss (checkpoints, landed files, versioned
tables, stream checkpoints) goes under the cluster's ``spark.checkpoint.dir``.
A purely local session (tests) without one gets a private folder; on any
other master a missing shared folder is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Starting settings for a large cluster (pass as ``extra`` to ``build_session`` or to
    spark-submit). AQE coalesces the initial shuffle partitions down to ~256 MB each and
    splits skewed ones, so the initial count only needs to be large enough for the biggest
    shuffle: input bytes / 512 MB, at least 3x the cores."""
    initial = max(3 * total_cores, int(input_tb * 1024 * 1024 / 512))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "256m",
        "spark.sql.parquet.aggregatePushdown": "true",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app: str = "barmarts", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):  # local mode: the driver JVM is the whole cluster
        conf.setdefault("spark.driver.memory", os.environ.get("BARMARTS_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - connect sessions have no SparkContext
        root = None
    if root:
        return root
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # Unset: a local test session. Create a private folder and register it.
    root = tempfile.mkdtemp(prefix="barmarts-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def shared_dir(spark: SparkSession, *parts: str, fresh: bool = True) -> str:
    """A folder under the shared checkpoint root; ``fresh`` adds a unique leaf."""
    root = _checkpoint_root(spark).rstrip("/")
    leaf = list(parts) + ([uuid.uuid4().hex] if fresh else [])
    return "/".join([root, *leaf])


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
