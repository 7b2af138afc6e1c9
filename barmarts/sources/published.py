"""S6, S7 with catalog objects: a model is written beside the current one, then its view is
replaced.

``CREATE OR REPLACE VIEW`` is one catalog change, so readers see the old table or the new one,
never a mixture, and a stop before it leaves the old one readable. The folder that the view
showed before is kept for readers that have begun; older ones are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barmarts.session import shared_dir
from barmarts.sources.tables import _fs_path


def publish(df: DataFrame, name: str, root: str, sort_by: list[str] | None = None) -> DataFrame:
    """Replace the published table ``name`` (schema.table or table) by ``df``, stored under
    ``root``; returns it as readers see it."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name.split('.')[0]}`")
    folder = f"{root}/{name}"
    before = _folders(spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(path)
    _show(spark, name, path)
    for old in before[:-1]:
        p, fs = _fs_path(spark, f"{folder}/{old}")
        fs.delete(p, True)
    return spark.table(name)


def _folders(spark: SparkSession, folder: str) -> list[str]:
    """Written states, oldest first."""
    p, fs = _fs_path(spark, folder)
    found = list(fs.listStatus(p)) if fs.exists(p) else []
    return [s.getPath().getName() for s in sorted(found, key=lambda s: s.getModificationTime())]


def _show(spark: SparkSession, name: str, path: str) -> None:
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT * FROM parquet.`{path}`")


def publisher(spark: SparkSession, schemas: dict[str, str], root: str | None = None):
    """A ``store`` for ``plans.pipeline.materialise_marts``: model ``m`` is published as
    ``<schemas[m]>.m`` (layer = schema)."""
    root = root or shared_dir(spark, "published", fresh=False)
    return lambda df, name, sort_by=None: publish(df, f"{schemas[name]}.{name}", root, sort_by)
