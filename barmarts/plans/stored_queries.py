"""Registered queries over stored and streamed tables: clustered and published storage, observed
writes, backfill with faults, stateful streams, mergeable parts. Each lands or stores what it
needs from the driver's tables and returns what the stored form gives."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmarts.operators import gold, incremental, quality
from barmarts.operators.observed import batch_metrics, store_observed
from barmarts.operators.silver import silver
from barmarts.plans.pipeline import historical_load, materialise_marts
from barmarts.schemas import BRONZE_COLUMNS, DEFAULT_UNIVERSE
from barmarts.session import shared_dir
from barmarts.sources.clustered import read_clustered, write_clustered
from barmarts.sources.landing import read_vendor_csv, register_view, universe_frame
from barmarts.sources.published import publisher
from barmarts.sources.tables import bronze_table, read_table

# --- fixed query parameters -------------------------------------------------------------
LOOKUP_SYMBOLS, LOOKUP_DATES = ("Brand#3", "Brand#5"), ("1999-03-01", "1999-08-31")
BACKFILL_START = "1998-01-01"
BAD_VOLUME, EXTRA_HEADER, MALFORMED_LINES = "Brand#3", "Brand#5", "Brand#7"
MALFORMED_MONTH = "1999-05"
#: Three landings by date; some symbols' last days of the first come with the second.
LANDING_CUTS = ("1999-01-01", "2000-06-01")
LATE_SYMBOLS, LATE_FROM = ("Brand#1", "Brand#2"), "1998-11-10"
REPEATED_FROM = "2000-05-01"
DELAY_DAYS, STREAM_SYMBOLS = 90, 25


def clustered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of a symbol range and a date range out of clustered storage."""
    path = f"{shared_dir(spark, 'clustered')}/bars"
    write_clustered(bronze_table(spark, sf), path, ["symbol", "price_date"])
    return read_clustered(spark, path, symbol=LOOKUP_SYMBOLS, price_date=tuple(F.lit(d).cast("date") for d in LOOKUP_DATES))


def published_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """S6 through the catalog: every model published twice (first over the early bars only); what a
    reader of the alerts sees afterwards."""
    own, root = uuid.uuid4().hex[:12], shared_dir(spark, "published")
    layers = {"silver": f"silver_{own}", **dict.fromkeys(("monthly", "long_term", "market_summary", "risk", "alerts"), f"gold_{own}")}
    bars = bronze_table(spark, sf)
    store = publisher(spark, layers, root)
    for batch in (bars.where(F.col("price_date") < F.lit(LANDING_CUTS[0]).cast("date")), bars):
        materialise_marts(spark, batch, root, store=store)
    return spark.table(f"{layers['alerts']}.alerts").drop("gold_created_at_utc")


def registered_view_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The batch under a view name, read by SQL."""
    name = f"landed_{uuid.uuid4().hex[:12]}"
    register_view(bronze_table(spark, sf), name)
    return spark.sql(f"SELECT load_type, COUNT(*) AS bars, COUNT(DISTINCT symbol) AS symbols, MAX(price_date) AS latest FROM {name} GROUP BY load_type")


def observed_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Q12, Q14, A10 of the landed drops, measured by the write that stores them."""
    from barmarts.plans.registry import _landed_drops
    batch = _landed_drops(spark, sf)
    stored, seen = store_observed(batch, f"{shared_dir(spark, 'observed')}/drops", **batch_metrics(batch))
    return stored.agg(F.count(F.lit(1)).alias("stored_rows")).select(
        "stored_rows", *(F.lit(seen[c]).alias(c) for c in ("total_rows", "null_required", "earliest_date", "latest_date")))


def _faulty_landing(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Vendor files of all bars: one symbol's volumes of each first day of a month are no numbers,
    one has an extra header line, one's lines of a month lack their last field."""
    from barmarts.plans.registry import _vendor_shaped
    rows = _vendor_shaped(spark, sf)
    symbol, month = F.col("` Symbol `"), F.substring("Date", 1, 7)
    short = (symbol == MALFORMED_LINES) & (month == MALFORMED_MONTH)
    first = F.substring("Date", 9, 2) == "01"
    rows = rows.withColumn("Volume", F.when((symbol == BAD_VOLUME) & first, "n/a").otherwise(F.col("Volume")))
    extra = rows.where(symbol == EXTRA_HEADER).limit(1).withColumn("Date", F.lit("Date"))
    rows.where(~short).unionByName(extra).write.option("header", True).csv(f"{root}/landing")
    # one file of lines that lack their last field, under the whole header
    lines = rows.where(short).select(F.concat_ws(",", *[f"`{c}`" for c in rows.columns[:-1]]).alias("value"))
    head = spark.createDataFrame([(",".join(c.strip() for c in rows.columns),)], "value string")
    head.unionByName(lines).coalesce(1).write.mode("append").text(f"{root}/landing")
    return read_vendor_csv(spark, f"{root}/landing")


def backfill_report(spark: SparkSession, sf: str) -> DataFrame:
    """G7 whole: faults, a start bound, silent symbols; rejected rows by symbol and reason, and the
    rows that were loaded (reason 'loaded')."""
    from barmarts.operators.upsert import read_bronze
    root = shared_dir(spark, "backfill-report")
    universe = universe_frame(spark, [*(f"Brand#{k}" for k in range(1, 26)), *DEFAULT_UNIVERSE])
    report = historical_load(spark, _faulty_landing(spark, sf, root), f"{root}/bronze", "yahoo_finance", uuid.uuid4().hex,
                             "2024-01-02 00:00:00", start_date=BACKFILL_START, universe=universe)
    rows = report.select("symbol", F.col("reject_reason").alias("reason")).unionByName(
        read_bronze(spark, f"{root}/bronze").select("symbol", F.lit("loaded").alias("reason")))
    return rows.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("rows"))


def _landings(spark: SparkSession, sf: str) -> list[DataFrame]:
    bars, day = bronze_table(spark, sf), F.col("price_date")
    def date(d):
        return F.lit(d).cast("date")
    late = F.col("symbol").isin(*LATE_SYMBOLS) & (day >= date(LATE_FROM)) & (day < date(LANDING_CUTS[0]))
    second = (day >= date(LANDING_CUTS[0])) & (day < date(LANDING_CUTS[1]))
    return [bars.where((day < date(LANDING_CUTS[0])) & ~late), bars.where(second | late),
            bars.where(day >= date(REPEATED_FROM))]  # repeats a month of the second


def _streamed(spark: SparkSession, sf: str, name: str, run) -> DataFrame:
    """Three landings; the stream is started anew after each, with the state it left."""
    root = shared_dir(spark, name)
    for drop in _landings(spark, sf):
        drop.write.mode("append").option("header", True).csv(f"{root}/landing")
        out = run(f"{root}/landing", f"{root}/out", f"{root}/checkpoint")
    return out


def stream_newest_bars(spark: SparkSession, sf: str) -> DataFrame:
    """F5 as a stream."""
    from barmarts.streaming.state import run_newest_bars
    return _streamed(spark, sf, "stream-newest", lambda *paths: run_newest_bars(spark, *paths))


def stream_closed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Q13 by day as a stream."""
    from barmarts.streaming.state import run_closed_days
    return _streamed(spark, sf, "stream-days", lambda *paths: run_closed_days(spark, *paths, f"{DELAY_DAYS} days", STREAM_SYMBOLS))


def risk_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    """G5 from stored moments: the parts of early years are written first, later ones appended."""
    path = f"{shared_dir(spark, 'risk-parts')}/parts"
    parts = incremental.risk_parts(gold.monthly_performance(silver(bronze_table(spark, sf))))
    for years in (F.col("year") < 1999, F.col("year") >= 1999):
        parts.where(years).write.mode("append").parquet(path)
    return incremental.risk_from_parts(spark.read.parquet(path))


def profile_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """A10 from stored monthly sketches, and whether the estimate is within three standard errors."""
    path, bars = f"{shared_dir(spark, 'sketches')}/months", bronze_table(spark, sf)
    incremental.month_sketches(bars).write.parquet(path)
    about = incremental.profile_from_sketches(spark.read.parquet(path))
    exact = bars.agg(F.count_distinct("symbol").alias("exact"))
    off = F.abs(F.col("about_symbols") - F.col("exact"))
    return about.crossJoin(exact).select(  # one row each
        "total_rows", "earliest_date", "latest_date", "exact", (off <= 3 * incremental.STANDARD_ERROR * F.col("exact") + 0.5).alias("within_bound"))


def silver_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """G1 after an upsert: stored Silver and chunk table, one upsert, changed chunks computed anew."""
    from barmarts.operators import refresh
    from barmarts.operators.upsert import read_bronze, upsert_into_path
    from barmarts.plans.registry import _upsert_inputs
    root = shared_dir(spark, "silver-refresh")

    def store(df, name):
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    def months(df):
        return [r[0].strftime("%Y-%m") for r in df.select("_chunk").distinct().collect()]  # bounded by the calendar
    target, batch = _upsert_inputs(spark, sf)
    bars = upsert_into_path(spark, f"{root}/bronze", target)
    old, chunks = store(silver(bars), "silver"), store(refresh.month_chunks(bars), "chunks")
    upsert_into_path(spark, f"{root}/bronze", batch)
    touched = store(refresh.touched_chunks(batch), "touched")
    after = store(refresh.refreshed_chunks(chunks, touched, read_bronze(spark, f"{root}/bronze", months(touched))), "chunks-after")
    changed = store(refresh.changed_chunks(chunks, after, touched), "changed")
    return store(refresh.refresh_silver(old, changed, read_bronze(spark, f"{root}/bronze", months(changed)), after), "silver-after")


def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """J9 on a table bucketed by key: only the batch is shuffled."""
    from barmarts.operators.upsert import create_bucketed, upsert
    from barmarts.plans.registry import _upsert_inputs
    target, batch = _upsert_inputs(spark, sf)
    name, buckets = f"bars_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    return upsert(create_bucketed(target, name, buckets, f"{shared_dir(spark, 'bucketed')}/bars"), batch)


def _suspects(spark: SparkSession, sf: str) -> DataFrame:
    from barmarts.plans.registry import LINEITEM_KEY
    return quality.suspect_rows(read_table(spark, sf, "lineitem"), LINEITEM_KEY, f"{shared_dir(spark, 'suspects')}/hashes")


def duplicate_keys_two_pass(spark: SparkSession, sf: str) -> DataFrame:
    """A12 where only keys whose hash occurs twice are grouped."""
    from barmarts.plans.registry import LINEITEM_KEY
    return quality.duplicate_keys(_suspects(spark, sf), LINEITEM_KEY)


def duplicate_row_count_two_pass(spark: SparkSession, sf: str) -> DataFrame:
    """A13 where only keys whose hash occurs twice are grouped."""
    from barmarts.plans.registry import LINEITEM_KEY
    return quality.duplicate_row_count(_suspects(spark, sf), LINEITEM_KEY)


def stored_queries() -> dict:
    return {f.__name__: f for f in (
        clustered_lookup, published_alerts, registered_view_profile, observed_profile, backfill_report, stream_newest_bars,
        stream_closed_days, risk_from_parts, profile_from_sketches, silver_refresh, upsert_bucketed,
        duplicate_keys_two_pass, duplicate_row_count_two_pass)}


def _upserted(R) -> str:
    """Bars after the upsert: the batch wins, the rest of the target stays."""
    return f"""SELECT * REPLACE (CASE WHEN price_date >= DATE '{R.UPSERT_BATCH_FROM}' THEN adjusted_close * 2 ELSE adjusted_close END AS adjusted_close,
        CASE WHEN price_date >= DATE '{R.UPSERT_BATCH_FROM}' THEN 'incremental' ELSE load_type END AS load_type) FROM bars"""


def stored_sql() -> dict[str, str]:
    from barmarts.plans import registry as R
    from barmarts.plans.oracle import BARS, BRONZE_COLS, NULL_REQUIRED, STD, _drops_cte, alerts_body, risk_body, silver_cte
    bars = "WITH " + BARS
    brands = " UNION ALL ".join([f"SELECT unnest([{', '.join(repr(s) for s in [*(f'Brand#{k}' for k in range(1, 26)), *DEFAULT_UNIVERSE])}]) AS symbol"])
    bad = f"(symbol = '{BAD_VOLUME}' AND day(price_date) = 1)"
    short = f"(symbol = '{MALFORMED_LINES}' AND strftime(price_date, '%Y-%m') = '{MALFORMED_MONTH}')"
    upserted = _upserted(R)
    keys = ", ".join(R.LINEITEM_KEY)
    return {
        # by rank within the key, not by a group count
        "duplicate_keys_two_pass": f"""SELECT {keys}, MAX(k) AS row_count FROM (SELECT {keys}, ROW_NUMBER() OVER (PARTITION BY {keys}) AS k FROM lineitem)
            GROUP BY {keys} HAVING MAX(k) > 1""",
        "duplicate_row_count_two_pass": f"""SELECT COUNT(*) FILTER (WHERE k > 1) AS duplicate_rows, COUNT(*) FILTER (WHERE k = 2) AS duplicate_groups
            FROM (SELECT ROW_NUMBER() OVER (PARTITION BY {keys}) AS k FROM lineitem)""",
        "silver_refresh": bars + f", up AS ({upserted})," + silver_cte("up") + " SELECT * FROM silver",
        "upsert_bucketed": bars + f", up AS ({upserted}) SELECT * FROM up",
        "clustered_lookup": bars + f""" SELECT * FROM bars WHERE symbol BETWEEN '{LOOKUP_SYMBOLS[0]}' AND '{LOOKUP_SYMBOLS[1]}'
            AND price_date BETWEEN DATE '{LOOKUP_DATES[0]}' AND DATE '{LOOKUP_DATES[1]}'""",
        "published_alerts": "WITH " + ",".join(STD) + alerts_body(),
        "registered_view_profile": bars + " SELECT load_type, COUNT(*) AS bars, COUNT(DISTINCT symbol) AS symbols, MAX(price_date) AS latest FROM bars GROUP BY load_type",
        "observed_profile": bars + "," + _drops_cte(R.DROP_B, R.DROP_B_SYMBOLS) + f"""
            SELECT COUNT(*) AS stored_rows, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {NULL_REQUIRED}) AS null_required,
                   MIN(price_date) AS earliest_date, MAX(price_date) AS latest_date FROM drops""",
        "backfill_report": bars + f""", rows AS (SELECT symbol, {bad} AS bad, {short} AS short FROM bars WHERE price_date >= DATE '{BACKFILL_START}'),
            ill AS (SELECT DISTINCT symbol FROM rows WHERE bad OR short),
            said AS (SELECT symbol, CASE WHEN bad THEN 'cast_failed:volume' WHEN short THEN 'malformed_line'
                                         WHEN symbol IN (SELECT symbol FROM ill) THEN 'symbol_failed' ELSE 'loaded' END AS reason FROM rows
                     UNION ALL SELECT '{EXTRA_HEADER}', 'header_row'
                     UNION ALL SELECT symbol, 'nothing_returned' FROM ({brands}) u WHERE symbol NOT IN (SELECT symbol FROM rows))
            SELECT symbol, reason, COUNT(*) AS rows FROM said GROUP BY symbol, reason""",
        "stream_newest_bars": bars + f" SELECT {BRONZE_COLS} FROM bars QUALIFY price_date = MAX(price_date) OVER (PARTITION BY symbol)",
        "stream_closed_days": bars + f""" SELECT price_date, COUNT(DISTINCT symbol) AS n_symbols, {STREAM_SYMBOLS} - COUNT(DISTINCT symbol) AS n_missing
            FROM bars GROUP BY price_date HAVING price_date + 1 <= (SELECT MAX(price_date) FROM bars) - {DELAY_DAYS}""",
        "risk_from_parts": "WITH " + ",".join(STD) + risk_body(),
        "profile_from_sketches": bars + """ SELECT COUNT(*) AS total_rows, MIN(price_date) AS earliest_date, MAX(price_date) AS latest_date,
            COUNT(DISTINCT symbol) AS exact, TRUE AS within_bound FROM bars""",
    }
