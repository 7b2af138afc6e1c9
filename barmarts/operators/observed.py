"""Q12, Q14, A10 measured while a batch is written: ``DataFrame.observe`` adds the counts to the
plan that writes, so a gate judges the rows that were written and nothing is read twice.

Metrics are plain aggregates and reach the driver as one row. A task that is run again counts
once (Spark keeps the metrics of the attempt that succeeded).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barmarts.operators.quality import GateError, required_null_flag
from barmarts.schemas import REQUIRED_NOT_NULL


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` that measures ``metrics`` whenever an action runs it."""
    watch = Observation()
    return df.observe(watch, *[c.alias(name) for name, c in metrics.items()]), watch


def store_observed(df: DataFrame, path: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to ``path`` once; the written table and the metrics of that write."""
    watched, watch = observed(df, **metrics)
    watched.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), watch.get


def batch_metrics(batch: DataFrame, required: list[str] = REQUIRED_NOT_NULL,
                  sound: Column | None = None) -> dict[str, Column]:
    """Rows, rows with a required value missing, first and last date, distinct symbols (about), of
    the ``sound`` rows (default: all)."""
    ok = F.lit(True) if sound is None else sound
    return {
        "total_rows": F.count_if(ok), "null_required": F.count_if(ok & required_null_flag(batch, required)),
        "earliest_date": F.min(F.when(ok, F.col("price_date"))), "latest_date": F.max(F.when(ok, F.col("price_date"))),
        "about_symbols": F.approx_count_distinct(F.when(ok, F.col("symbol"))),
    }


def judge(seen: dict, nulls: bool = True) -> None:
    """Raise ``GateError`` for an empty batch (Q14) or one with missing required values (Q12)."""
    failed = []
    if nulls and seen["null_required"]:
        failed.append(f"no_null_required={seen['null_required']}")
    if not seen["total_rows"]:
        failed.append("not_empty=1")
    if failed:
        raise GateError(f"landing batch refused: {', '.join(failed)}")
