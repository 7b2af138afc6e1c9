"""Alert classification expressions.

Thresholds are tested on the unrounded percent; only the display value is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barmarts.schemas import MOMENTUM_THRESHOLD, STRONG_THRESHOLD


def alert_type(pct: Column, strong: float = STRONG_THRESHOLD,
               momentum: float = MOMENTUM_THRESHOLD) -> Column:
    return (F.when(pct >= strong, "STRONG_GAIN")
            .when(pct <= -strong, "SHARP_DROP")
            .when(pct >= momentum, "POSITIVE_MOMENTUM")
            .when(pct <= -momentum, "NEGATIVE_MOMENTUM"))


def alert_severity(pct: Column, strong: float = STRONG_THRESHOLD,
                   momentum: float = MOMENTUM_THRESHOLD) -> Column:
    return (F.when((pct >= strong) | (pct <= -strong), "HIGH")
            .when((pct >= momentum) | (pct <= -momentum), "MEDIUM"))


def alert_message(symbol: Column, kind: Column, month: Column, shown_pct: Column) -> Column:
    """'<sym> had a <type> signal in <YYYY-MM-DD> with a monthly return of <x.xx>%.'"""
    return F.concat(symbol, F.lit(" had a "), kind, F.lit(" signal in "), month.cast("string"),
                    F.lit(" with a monthly return of "), shown_pct.cast("string"), F.lit("%."))
