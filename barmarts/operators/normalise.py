"""Shaping landed vendor batches into the Bronze contract.

Header work (P1, P2, P4) touches only the schema: it runs on the driver over column
names and never looks at data. Casts (P5) run under ANSI, so a bad value such as a
volume of ``"12x"`` fails the job with CAST_INVALID_INPUT instead of becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.schemas import BRONZE, BRONZE_COLUMNS, VENDOR_RENAMES

#: Column of the landing reader that holds a line of another length than the header.
MALFORMED = "_malformed"
# Values a vendor's second/third header line puts in the date column.
HEADER_ROW_LABELS = ["Ticker", "Date", "Price"]


def normalise_name(name: str) -> str:
    """strip, lower, ' ' -> '_', drop '.'; a two-level name 'a|b' keeps its first level."""
    first = str(name).split("|")[0]
    return first.strip().lower().replace(" ", "_").replace(".", "")


def normalise_headers(df: DataFrame) -> DataFrame:
    """P1."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def is_header_row(df: DataFrame, date_col: str = "price_date") -> Column:
    """An extra header line of a two-level vendor file (typed dates have none)."""
    if dict(df.dtypes).get(date_col) != "string":
        return F.lit(False)
    return F.coalesce(F.col(date_col).isin(HEADER_ROW_LABELS), F.lit(False))


def drop_header_rows(df: DataFrame, date_col: str = "price_date") -> DataFrame:
    """P1 for two-level vendor files read as CSV: drop the extra header lines."""
    return df.where(~is_header_row(df, date_col))


def rename_vendor_columns(df: DataFrame, renames: dict[str, str] = VENDOR_RENAMES) -> DataFrame:
    """Only the columns present are renamed."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def stamp_lineage(df: DataFrame, source_provider: str, load_type: str, batch_id: str,
                  ingested_at_utc: str, symbol: str | None = None) -> DataFrame:
    """Per-batch constants (passed in, so re-runs are reproducible)."""
    if load_type not in ("historical", "incremental"):
        raise ValueError(f"load_type must be historical or incremental, got {load_type!r}")
    cols = {
        "source_provider": F.lit(source_provider),
        "load_type": F.lit(load_type),
        "batch_id": F.lit(batch_id),
        "ingested_at_utc": F.to_timestamp_ntz(F.lit(ingested_at_utc)),
    }
    if symbol is not None:
        cols["symbol"] = F.lit(symbol)
    return df.withColumns(cols)


def require_columns(df: DataFrame, columns: list[str] = BRONZE_COLUMNS) -> DataFrame:
    """Raise naming the missing columns (schema only, no job)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def cast_to_bronze(df: DataFrame) -> DataFrame:
    """P5 + P6 + S8: typed columns in the fixed Bronze order."""
    exprs, kinds = [], dict(df.dtypes)
    for f in BRONZE.fields:
        c = F.col(f.name)
        if f.name == "price_date":
            c = F.to_date(c)
        elif f.name == "volume":
            # numeric text (integral or not) -> int64 exactly, bad text raises under ANSI
            c = (c.cast("decimal(38,10)") if kinds[f.name] == "string" else c).cast("bigint")
        else:
            c = c.cast(f.dataType)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def normalise_landing(df: DataFrame, source_provider: str | None = None,
                      load_type: str | None = None, batch_id: str | None = None,
                      ingested_at_utc: str | None = None, symbol: str | None = None,
                      tag_faults: bool = False) -> DataFrame:
    """P1-P6 composed. Lineage is stamped only when given (stored files already carry it).
    ``tag_faults`` keeps rows that do not fit and says why in ``_fault``: extra header lines
    (``header_row``), lines of another length (``malformed_line``, their text in ``_line``), values
    that do not cast. Without it, header lines are dropped and the others raise."""
    out = rename_vendor_columns(normalise_headers(df))
    if not tag_faults:
        if "price_date" in out.columns:
            out = drop_header_rows(out)
        if MALFORMED in out.columns:
            out = out.where(F.when(F.col(MALFORMED).isNull(), True).otherwise(
                F.raise_error(F.concat(F.lit("malformed line: "), F.col(MALFORMED))).cast("boolean")))
    if load_type is not None:
        out = stamp_lineage(out, source_provider, load_type, batch_id, ingested_at_utc, symbol)
    return (try_cast_to_bronze if tag_faults else cast_to_bronze)(require_columns(out))


def try_cast_to_bronze(df: DataFrame) -> DataFrame:
    """P5 without raising: typed columns plus ``_fault``, naming the first column whose value
    is there but does not cast (null if all do), and ``_line``, the text of a malformed line."""
    kinds, exprs, fault = dict(df.dtypes), [], F.lit(None).cast("string")
    for f in reversed(BRONZE.fields):
        raw = F.col(f.name)
        if f.name == "volume" and kinds[f.name] == "string":
            c = raw.try_cast("decimal(38,10)").try_cast("bigint")
        else:
            c = raw.try_cast(f.dataType)
        exprs.insert(0, c.alias(f.name))
        fault = F.when(raw.isNotNull() & c.isNull(), F.lit(f"cast_failed:{f.name}")).otherwise(fault)
    line = F.col(MALFORMED) if MALFORMED in df.columns else F.lit(None).cast("string")
    fault = F.when(line.isNotNull(), "malformed_line").when(is_header_row(df), "header_row").otherwise(fault)
    return df.select(*exprs, fault.alias("_fault"), line.alias("_line"))


def newest_bar_per_symbol(df: DataFrame, symbol: str = "symbol", date: str = "price_date") -> DataFrame:
    """the latest bar of each symbol (``rank() = 1`` by date descending): two different
    bars of the newest day both stay, so that the duplicate gate (Q11) can refuse them.

    Catalyst adds a partial WindowGroupLimit before the shuffle, so each task sends at
    most one row per symbol.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(symbol).orderBy(F.col(date).desc())
    return df.withColumn("_rn", F.rank().over(w)).where(F.col("_rn") == 1).drop("_rn")


def history_since(df: DataFrame, start: str, date: str = "price_date") -> DataFrame:
    """bars on or after the configured start date (pushed to the scan)."""
    return df.where(F.col(date) >= F.to_date(F.lit(start)))

