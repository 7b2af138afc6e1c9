"""Table contracts and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("price_date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("adjusted_close", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("source_provider", T.StringType(), False),
    T.StructField("load_type", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
    # UTC wall-clock instant, stored zone-free (the same type the landed parquet carries)
    T.StructField("ingested_at_utc", T.TimestampNTZType(), False),
])

BRONZE_COLUMNS = BRONZE.names
KEY = ["symbol", "price_date"]

SILVER_COLUMNS = [
    "symbol", "trading_day_number", "price_date", "opening_price", "high_price", "low_price",
    "closing_price", "adjusted_closing_price", "previous_adjusted_closing_price",
    "adjusted_close_5d_ago", "daily_return", "daily_return_pct", "return_5d", "return_5d_pct",
    "volume", "source_provider", "data_loaded_as", "batch_id", "ingested_at_utc",
]

# Silver columns allowed to be NULL (the lag and return columns); the other 14 are not_null.
SILVER_NULLABLE = [
    "previous_adjusted_closing_price", "adjusted_close_5d_ago", "daily_return",
    "daily_return_pct", "return_5d", "return_5d_pct",
]

LONG_TERM_COLUMNS = [
    "symbol", "start_date", "first_adjusted_closing_price", "end_date",
    "latest_adjusted_closing_price", "total_return", "total_return_pct",
]

MONTHLY_COLUMNS = [
    "symbol", "month_start_date", "first_trading_date_of_month", "last_trading_date_of_month",
    "first_adjusted_closing_price", "last_adjusted_closing_price", "monthly_return",
    "monthly_return_pct", "trading_days_count",
]

MARKET_SUMMARY_COLUMNS = [
    "month_start_date", "total_etfs_count", "positive_etfs_count", "negative_etfs_count",
    "flat_etfs_count", "avg_monthly_return_pct", "best_monthly_return_pct",
    "worst_monthly_return_pct", "best_performing_etf", "best_performing_etf_return_pct",
    "worst_performing_etf", "worst_performing_etf_return_pct", "positive_etf_ratio_pct",
]

RISK_COLUMNS = [
    "symbol", "total_months_count", "positive_months_count", "negative_months_count",
    "flat_months_count", "avg_monthly_return_pct", "best_monthly_return_pct",
    "worst_monthly_return_pct", "monthly_volatility_pct", "positive_month_ratio_pct",
    "return_to_risk_score",
]

ALERT_COLUMNS = [
    "symbol", "month_start_date", "monthly_return_pct", "alert_type", "alert_severity",
    "alert_message",
]

# --- fixed values (must equal the reference's for identical results) ------------------
# Symbol universe, in configured order.
DEFAULT_UNIVERSE = [
    "VOO", "SPY", "QQQ", "VGT", "VT", "VXUS", "BND", "GLD", "VEA", "VWO",
    "BNDX", "ACWI", "EFA", "IEMG", "EWJ", "MCHI", "INDA", "EWG", "EWU", "EWZ",
]
DEFAULT_PROVIDER = "yahoo_finance"
DEFAULT_START_DATE = "2015-01-01"
LOAD_TYPES = ["historical", "incremental"]
# Alert thresholds (percent) and labels.
STRONG_THRESHOLD = 8.0
MOMENTUM_THRESHOLD = 4.0
ALERT_TYPES = ["STRONG_GAIN", "SHARP_DROP", "POSITIVE_MOMENTUM", "NEGATIVE_MOMENTUM"]
ALERT_SEVERITIES = ["HIGH", "MEDIUM"]
# Columns every landed batch must carry (before typing) and the incremental null gate.
REQUIRED_NOT_NULL = ["price_date", "open", "high", "low", "close", "adjusted_close", "volume"]
# Vendor header renames after normalisation.
VENDOR_RENAMES = {"date": "price_date", "adj_close": "adjusted_close"}
# Dashboard horizons: name -> months back (None = special rule).
HORIZON_MONTHS = {"1M": 1, "3M": 3, "6M": 6, "1Y": 12, "3Y": 36, "5Y": 60}
HORIZONS = ["1D", "1W", "1M", "3M", "6M", "YTD", "1Y", "3Y", "5Y", "MAX"]
SNAPSHOT_DAYS = 30
