"""Profiles (A10-A13), data checks (Q1-Q10) and batch gates (Q11-Q15).

Checks return DataFrames shaped ``(check, table_name, column_name, failed_rows)``; a
check passes when ``failed_rows == 0``. All not_null checks of one table share one
aggregate pass. Gates evaluate to one small report row per gate and raise on failure;
only that report (a handful of rows) reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.schemas import KEY, REQUIRED_NOT_NULL

REPORT_COLUMNS = ["check", "table_name", "column_name", "failed_rows"]


class GateError(ValueError):
    """A landed batch failed a gate; nothing was written."""


def _report(check: str, table: str, column: str, failed: Column) -> list[Column]:
    return [F.lit(check).alias("check"), F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"), failed.cast("bigint").alias("failed_rows")]


def union_reports(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


# --- profiles ----------------------------------------------------------------------------

def table_profile(df: DataFrame, symbol: str = "symbol", date: str = "price_date",
                  approx: bool = False) -> DataFrame:
    """A10: rows, distinct symbols, earliest and latest date in one aggregate."""
    distinct = F.approx_count_distinct(symbol) if approx else F.count_distinct(F.col(symbol))
    return df.agg(F.count(F.lit(1)).alias("total_rows"), distinct.alias("total_symbols"),
                  F.min(date).alias("earliest_date"), F.max(date).alias("latest_date"))


def profile_by_symbol(df: DataFrame, keys: list[str] = KEY, symbol: str = "symbol",
                      date: str = "price_date") -> DataFrame:
    """Per symbol rows, date range and duplicate rows (rows beyond the first per key).

    Two-level aggregate: by key (combines map-side, so a repeated key costs one row per
    task), then by symbol.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(symbol).agg(
        F.sum("_n").alias("row_count"), F.min(date).alias("min_date"),
        F.max(date).alias("max_date"), F.sum(F.col("_n") - 1).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Key groups seen more than once (GROUP BY key HAVING COUNT(*) > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def duplicate_row_count(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows beyond the first of each key (pandas ``duplicated().sum()``); one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("duplicate_groups"))


def suspect_rows(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """First pass of A12, A13 and Q9 over mostly unique keys: the rows whose 64-bit key hash occurs
    more than once (NULLs are values, as in ``groupBy``). Only hashes are shuffled, combined per
    task; those seen twice are written to the new folder ``path``, so their size is known when
    the rows are joined to them: few are broadcast, and unique keys never reach a second shuffle;
    many are sort-merged. A hash collision only lets a row through: ``duplicate_keys``,
    ``duplicate_row_count`` and ``unique_report`` judge the rows by the whole key and give the same
    result as on ``df``.
    """
    hashed = F.xxhash64(*keys)
    (df.groupBy(hashed.alias("_key_hash")).agg(F.count(F.lit(1)).alias("_n"))
     .where(F.col("_n") > 1).select("_key_hash").write.parquet(path))
    suspects = df.sparkSession.read.schema("_key_hash bigint").parquet(path)
    return df.join(suspects, hashed == suspects["_key_hash"], "left_semi")


# --- checks Q1-Q10 -----------------------------------------------------------------------

def not_null_report(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Q1-Q3: NULL count per column, one aggregate pass for all columns of a table."""
    counts = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)), F.lit(0))
                      .cast("bigint").alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "failed_rows")
    return long.select(F.lit("not_null").alias("check"), F.lit(table).alias("table_name"),
                       "column_name", "failed_rows")


def unique_report(df: DataFrame, table: str, columns: list[str], check: str = "unique") -> DataFrame:
    """Q4 / Q9: number of key groups that occur more than once. ``unique`` (Q4) leaves NULL
    keys out, ``composite_key`` (Q9) counts them like any other value."""
    keyed = df if check == "composite_key" else df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    dup = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(*_report(check, table, ",".join(columns), F.count(F.lit(1))))


def accepted_values_report(df: DataFrame, table: str, column: str, values: list) -> DataFrame:
    """Q5-Q8: rows whose non-NULL value lies outside ``values`` (NULL is not flagged)."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return df.agg(*_report("accepted_values", table, column,
                           F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0))))


def accepted_values_multi(df: DataFrame, table: str, accepted: dict[str, list]) -> DataFrame:
    """Q5-Q8 for several columns of one table in a single aggregate pass."""
    cols = list(accepted)
    counts = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(v)), 1)
                                       .otherwise(0)), F.lit(0)).cast("bigint").alias(c)
                      for c, v in accepted.items()])
    return (counts.unpivot([], cols, "column_name", "failed_rows")
            .select(F.lit("accepted_values").alias("check"), F.lit(table).alias("table_name"),
                    "column_name", "failed_rows"))


def _recompute_failed(tolerance: float) -> tuple[Column, Column]:
    """(recomputed monthly pct, differs from the stored one by more than tolerance)."""
    first, last = F.col("first_adjusted_closing_price"), F.col("last_adjusted_closing_price")
    again = (F.try_divide(last, first) - 1) * 100
    return again, (first != 0) & (F.abs(F.col("monthly_return_pct") - again) > tolerance)


def recompute_failures(monthly: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Stored monthly pct differs from the recomputed one by more than tolerance."""
    again, failed = _recompute_failed(tolerance)
    return monthly.where(failed).select(
        "symbol", "month_start_date", "first_adjusted_closing_price", "last_adjusted_closing_price",
        "monthly_return_pct", again.alias("recalculated_monthly_return_pct"))


def recompute_report(monthly: DataFrame, table: str = "monthly", tolerance: float = 0.01) -> DataFrame:
    return recompute_failures(monthly, tolerance).agg(
        *_report("recompute", table, "monthly_return_pct", F.count(F.lit(1))))


def value_report(df: DataFrame, table: str, not_null: list[str], accepted: dict[str, list] | None = None,
                 recompute: bool = False, tolerance: float = 0.01) -> DataFrame:
    """All value tests of one table (Q1-Q3, Q5-Q8, Q10) in a single aggregate pass."""
    tests = {f"not_null|{c}": F.col(c).isNull() for c in not_null}
    tests |= {f"accepted_values|{c}": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in (accepted or {}).items()}
    if recompute:
        tests["recompute|monthly_return_pct"] = _recompute_failed(tolerance)[1]
    counts = df.agg(*[F.count_if(cond).cast("bigint").alias(name) for name, cond in tests.items()])
    parts = F.split("test", r"\|")
    return (counts.unpivot([], list(tests), "test", "failed_rows")
            .select(parts[0].alias("check"), F.lit(table).alias("table_name"), parts[1].alias("column_name"), "failed_rows"))


# --- gates Q11-Q15 -----------------------------------------------------------------------

def required_null_flag(df: DataFrame, columns: list[str] = REQUIRED_NOT_NULL) -> Column:
    """Any required column NULL, or NaN for the double columns (pandas counts NaN as null)."""
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float")}
    conds = [(F.col(c).isNull() | F.isnan(F.col(c))) if c in numeric else F.col(c).isNull()
             for c in columns]
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def gate_report(batch: DataFrame, universe: DataFrame | None = None, keys: list[str] = KEY,
                required: list[str] = REQUIRED_NOT_NULL, symbol: str = "symbol") -> DataFrame:
    """Q11-Q14 (+ S11): one row per gate ``(gate, failed, passed)``."""
    dup = duplicate_row_count(batch, keys).select(
        F.lit("no_duplicate_keys").alias("gate"), F.col("duplicate_rows").alias("failed"))
    # null/NaN count and emptiness in one pass over the batch
    flat = batch.agg(
        F.coalesce(F.sum(F.when(required_null_flag(batch, required), 1).otherwise(0)), F.lit(0))
        .cast("bigint").alias("no_null_required"),
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("not_empty"))
    parts = [dup, flat.unpivot([], ["no_null_required", "not_empty"], "gate", "failed")]
    if universe is not None:
        present = batch.select(F.col(symbol).alias("symbol")).distinct()
        miss = universe.select("symbol").join(present, "symbol", "left_anti")
        parts.append(miss.agg(F.count(F.lit(1)).cast("bigint").alias("failed"))
                     .select(F.lit("all_symbols_present").alias("gate"), "failed"))
    rep = union_reports(parts)
    return rep.select("gate", "failed", (F.col("failed") == 0).alias("passed"))


def missing_symbols(batch: DataFrame, universe: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Q13 detail: configured symbols absent from the batch (bounded by the universe)."""
    present = batch.select(F.col(symbol).alias("symbol")).distinct()
    return universe.select("symbol").join(present, "symbol", "left_anti")


def enforce_gates(batch: DataFrame, universe: DataFrame | None = None, keys: list[str] = KEY,
                  required: list[str] | None = REQUIRED_NOT_NULL) -> None:
    """Raise ``GateError`` naming every failed gate. Collects only the gate report."""
    rep = gate_report(batch, universe, keys, required or [])
    failed = {r["gate"]: r["failed"] for r in rep.collect() if not r["passed"]}
    if required is None:
        failed.pop("no_null_required", None)
    if not failed:
        return
    msg = ", ".join(f"{g}={n}" for g, n in sorted(failed.items()))
    if "all_symbols_present" in failed and universe is not None:
        names = [r["symbol"] for r in missing_symbols(batch, universe).orderBy("symbol").limit(20).collect()]
        msg += f"; missing symbols: {names}" + (" and more" if failed["all_symbols_present"] > 20 else "")
    raise GateError(f"landing batch refused: {msg}")


def split_rejects(batch: DataFrame, policy: str = "historical", keys: list[str] = KEY,
                  required: list[str] = REQUIRED_NOT_NULL, symbol: str = "symbol",
                  fault: str | None = None) -> DataFrame:
    """Q15: tag every row ``accepted`` / ``rejected`` with a reason.

    Row faults: one named in the column ``fault`` (a value that did not cast; the column is
    dropped), a required value NULL/NaN, or a key seen more than once. ``historical``
    rejects every row of a symbol with a faulty row and keeps the other symbols;
    ``incremental`` is all-or-nothing. Duplicate keys come from an aggregate joined back
    (a key repeated a million times is one aggregate row, and AQE splits the skewed join).
    """
    if policy not in ("historical", "incremental"):
        raise ValueError(f"unknown policy {policy!r}")
    dups = (batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
            .select(*keys, F.lit(True).alias("_dup")))
    columns = [c for c in batch.columns if c != fault]
    given = F.col(fault) if fault else F.lit(None).cast("string")
    rows = batch.join(dups, keys, "left").select(
        *columns,
        F.when(given.isNotNull(), given).when(required_null_flag(batch, required), "null_required")
         .when(F.col("_dup"), "duplicate_key").alias("_fault"))
    if policy == "historical":
        bad = rows.where(F.col("_fault").isNotNull()).select(symbol).distinct() \
            .select(F.col(symbol).alias("_bad_symbol"))
        rows = rows.join(bad, rows[symbol].eqNullSafe(bad["_bad_symbol"]), "left")
        reason = F.coalesce(F.col("_fault"),
                            F.when(F.col("_bad_symbol").isNotNull(), F.lit("symbol_failed")))
    else:
        n_bad = rows.where(F.col("_fault").isNotNull()).select(F.count(F.lit(1))).scalar()
        reason = F.coalesce(F.col("_fault"), F.when(n_bad > 0, F.lit("batch_failed")))
    return rows.select(*columns,
                       F.when(reason.isNull(), "accepted").otherwise("rejected").alias("status"),
                       reason.alias("reject_reason"))
