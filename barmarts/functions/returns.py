"""Scalar column expressions for returns and classification (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_return(cur, base) -> Column:
    """(cur - base) / base; NULL when base is NULL or 0 (never a division error)."""
    cur, base = _c(cur), _c(base)
    return F.when(base.isNull() | (base == 0), F.lit(None).cast("double")).otherwise((cur - base) / base)


def safe_return_pct(cur, base, scale: int = 4) -> Column:
    """Same as ``safe_return`` expressed in percent and rounded to ``scale`` places."""
    cur, base = _c(cur), _c(base)
    return F.when(base.isNull() | (base == 0), F.lit(None).cast("double")).otherwise(
        F.round(((cur - base) / base) * 100, scale))


def ratio_return_pct(last, first) -> Column:
    """((last / first) - 1) * 100, unrounded; NULL when first is 0 or NULL.

    Differs from ``safe_return`` in floating point; the marts use this operand order.
    """
    last, first = _c(last), _c(first)
    return F.when(first.isNull() | (first == 0), F.lit(None).cast("double")).otherwise(
        ((last / first) - 1) * 100)


def change(last, first) -> Column:
    return _c(last) - _c(first)


def is_positive(x) -> Column:
    return _c(x) > 0


def is_negative(x) -> Column:
    return _c(x) < 0


def is_flat(x) -> Column:
    return _c(x) == 0


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): 0, never NULL, on an all-NULL group."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def ratio_pct(num: Column, den: Column, scale: int = 2) -> Column:
    """ROUND(num * 100.0 / den, scale) as double (decimal arithmetic, then cast);
    NULL when den is 0."""
    return F.round(F.try_divide(num * F.lit(100.0).cast("decimal(4,1)"), den), scale).cast("double")


def month_start(d) -> Column:
    """First day of the month of a date column (DATE)."""
    return F.trunc(_c(d), "month")
