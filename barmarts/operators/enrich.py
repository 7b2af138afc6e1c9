"""Dimension enrichment (symbol -> name, asset class, region, category).

Left join, so bars of symbols missing from the dimension survive. A plain equi-join: AQE
broadcasts the dimension if its size in bytes at run time allows, and splits a hot symbol
of the bars otherwise. Nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_dimension(df: DataFrame, dimension: DataFrame, key: str = "symbol") -> DataFrame:
    return df.join(dimension, key, "left")
