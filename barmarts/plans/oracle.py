"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the rules, by other methods than the Spark operators where that adds a check:
lags by a self-join on the row's ordinal, leaders and laggards from ordered lists, deviations
from a second pass over the mean. Type and NULL-order differences between the engines are pinned here:
counts and CASE sums as BIGINT, ratios as DOUBLE, row_number as INTEGER, explicit
NULLS FIRST/LAST, and ``||`` where Spark's CONCAT would return NULL.
"""

from __future__ import annotations

BARS = """
bars AS (
  SELECT symbol, price_date,
         arg_min(px, seq) AS open, max(px) AS high, min(px) AS low,
         arg_max(px, seq) AS close, arg_max(px, seq) AS adjusted_close,
         CAST(SUM(l_quantity) AS BIGINT) AS volume,
         'synthetic' AS source_provider, 'historical' AS load_type, 'batch-0' AS batch_id,
         TIMESTAMP '2024-01-01 00:00:00' AS ingested_at_utc
  FROM (SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS price_date,
               l.l_extendedprice / l.l_quantity AS px,
               row(l.l_orderkey, l.l_linenumber, l.l_extendedprice, l.l_quantity) AS seq,
               l.l_quantity
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) t
  GROUP BY symbol, price_date
)"""


def silver_cte(src: str = "bars", name: str = "silver") -> str:
    """Cleaned bars. Kept bars are numbered per symbol; the bar n rows back is the one whose
    ordinal is smaller by n. Dividing by NULLIF(base, 0) covers the NULL and the zero base."""
    def change(base: str) -> str:
        return f"(now.adj - {base}.adj) / NULLIF({base}.adj, 0)"
    return f"""
{name}_n AS (
  SELECT *, adjusted_close AS adj, CAST(row_number() OVER (PARTITION BY symbol ORDER BY price_date) AS INTEGER) AS n
  FROM (SELECT * FROM {src} WHERE NOT (high < low) AND high + low IS NOT NULL
        AND symbol IS NOT NULL AND price_date IS NOT NULL AND adjusted_close IS NOT NULL AND volume IS NOT NULL) kept
),
{name} AS (
  SELECT now.symbol, now.n AS trading_day_number, now.price_date, now.open AS opening_price, now.high AS high_price,
    now.low AS low_price, now.close AS closing_price, now.adj AS adjusted_closing_price,
    one.adj AS previous_adjusted_closing_price, five.adj AS adjusted_close_5d_ago,
    {change('one')} AS daily_return, ROUND({change('one')} * 100, 4) AS daily_return_pct,
    {change('five')} AS return_5d, ROUND({change('five')} * 100, 4) AS return_5d_pct,
    now.volume, now.source_provider, now.load_type AS data_loaded_as, now.batch_id, now.ingested_at_utc
  FROM {name}_n now
  LEFT JOIN {name}_n one ON one.symbol = now.symbol AND one.n = now.n - 1
  LEFT JOIN {name}_n five ON five.symbol = now.symbol AND five.n = now.n - 5
)"""


def monthly_cte(src: str = "silver", name: str = "monthly") -> str:
    """Month-by-month from first/last rows picked by window ranks (QUALIFY)."""
    return f"""
{name}_m AS (
  SELECT symbol, price_date, adjusted_closing_price,
         CAST(date_trunc('month', price_date) AS DATE) AS month_start_date,
         COUNT(*) OVER (PARTITION BY symbol, date_trunc('month', price_date)) AS trading_days_count
  FROM {src}
),
{name}_first AS (
  SELECT * FROM {name}_m
  QUALIFY row_number() OVER (PARTITION BY symbol, month_start_date ORDER BY price_date) = 1
),
{name}_last AS (
  SELECT * FROM {name}_m
  QUALIFY row_number() OVER (PARTITION BY symbol, month_start_date ORDER BY price_date DESC) = 1
),
{name} AS (
  SELECT f.symbol, f.month_start_date,
         f.price_date AS first_trading_date_of_month, l.price_date AS last_trading_date_of_month,
         f.adjusted_closing_price AS first_adjusted_closing_price,
         l.adjusted_closing_price AS last_adjusted_closing_price,
         l.adjusted_closing_price - f.adjusted_closing_price AS monthly_return,
         (l.adjusted_closing_price / NULLIF(f.adjusted_closing_price, 0) - 1) * 100 AS monthly_return_pct,
         f.trading_days_count
  FROM {name}_first f JOIN {name}_last l USING (symbol, month_start_date)
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


STD = (BARS, silver_cte(), monthly_cte())

SILVER_COLS = ("symbol, trading_day_number, price_date, opening_price, high_price, low_price, "
               "closing_price, adjusted_closing_price, previous_adjusted_closing_price, "
               "adjusted_close_5d_ago, daily_return, daily_return_pct, return_5d, return_5d_pct, "
               "volume, source_provider, data_loaded_as, batch_id, ingested_at_utc")

MONTHLY_COLS = ("symbol, month_start_date, first_trading_date_of_month, last_trading_date_of_month, "
                "first_adjusted_closing_price, last_adjusted_closing_price, monthly_return, "
                "monthly_return_pct, trading_days_count")


def market_summary_body(src: str = "monthly") -> str:
    """Each month as two ordered lists (best first, worst first); everything is read off them."""
    def share(test: str) -> str:
        return f"CAST(len(list_filter(up, lambda x: x.p {test})) AS BIGINT)"
    return f"""
, ms AS (
  SELECT month_start_date,
    list({{'p': monthly_return_pct, 's': symbol}} ORDER BY monthly_return_pct DESC NULLS LAST, symbol) AS up,
    list({{'p': monthly_return_pct, 's': symbol}} ORDER BY monthly_return_pct ASC NULLS FIRST, symbol) AS down,
    SUM(monthly_return_pct) / NULLIF(COUNT(monthly_return_pct), 0) AS mean
  FROM {src} GROUP BY month_start_date
)
SELECT month_start_date, CAST(len(up) AS BIGINT) AS total_etfs_count,
  {share('> 0')} AS positive_etfs_count, {share('< 0')} AS negative_etfs_count, {share('= 0')} AS flat_etfs_count,
  ROUND(mean, 2) AS avg_monthly_return_pct, ROUND(up[1].p, 2) AS best_monthly_return_pct,
  ROUND(list_min(list_transform(down, lambda x: x.p)), 2) AS worst_monthly_return_pct,
  up[1].s AS best_performing_etf, ROUND(up[1].p, 2) AS best_performing_etf_return_pct,
  down[1].s AS worst_performing_etf, ROUND(down[1].p, 2) AS worst_performing_etf_return_pct,
  CAST(ROUND({share('> 0')} * 100.0 / len(up), 2) AS DOUBLE) AS positive_etf_ratio_pct
FROM ms
"""


def risk_body(src: str = "monthly") -> str:
    """Counts by sign, then deviations from the mean in a second pass."""
    return f"""
, rs AS (
  SELECT symbol, SUM(n) AS months, COALESCE(SUM(n) FILTER (WHERE way = 1), 0) AS ups,
    COALESCE(SUM(n) FILTER (WHERE way = -1), 0) AS downs, COALESCE(SUM(n) FILTER (WHERE way = 0), 0) AS flats,
    MAX(top) AS top, MIN(low) AS low, SUM(total) / NULLIF(SUM(known), 0) AS mean, SUM(known) AS known
  FROM (SELECT symbol, sign(monthly_return_pct) AS way, COUNT(*) AS n, COUNT(monthly_return_pct) AS known,
               MAX(monthly_return_pct) AS top, MIN(monthly_return_pct) AS low, SUM(monthly_return_pct) AS total
        FROM {src} GROUP BY ALL) by_sign
  GROUP BY symbol
), spread AS (
  SELECT symbol, ROUND(CASE WHEN any_value(rs.known) > 1
      THEN sqrt(SUM((m.monthly_return_pct - rs.mean) * (m.monthly_return_pct - rs.mean)) / (any_value(rs.known) - 1)) END, 2) AS sd
  FROM {src} m JOIN rs USING (symbol) GROUP BY symbol
)
SELECT symbol, CAST(months AS BIGINT) AS total_months_count, CAST(ups AS BIGINT) AS positive_months_count,
  CAST(downs AS BIGINT) AS negative_months_count, CAST(flats AS BIGINT) AS flat_months_count,
  ROUND(mean, 2) AS avg_monthly_return_pct, ROUND(top, 2) AS best_monthly_return_pct,
  ROUND(low, 2) AS worst_monthly_return_pct, sd AS monthly_volatility_pct,
  CAST(ROUND(ups * 100.0 / months, 2) AS DOUBLE) AS positive_month_ratio_pct,
  ROUND(ROUND(mean, 2) / NULLIF(sd, 0), 2) AS return_to_risk_score
FROM rs JOIN spread USING (symbol)
"""


def alerts_body(src: str = "monthly", strong: float = 8, momentum: float = 4) -> str:
    return f"""
, ar AS (
  SELECT symbol, month_start_date, monthly_return_pct,
    CASE WHEN monthly_return_pct >= {strong} THEN 'STRONG_GAIN'
         WHEN monthly_return_pct <= -{strong} THEN 'SHARP_DROP'
         WHEN monthly_return_pct >= {momentum} THEN 'POSITIVE_MOMENTUM'
         WHEN monthly_return_pct <= -{momentum} THEN 'NEGATIVE_MOMENTUM' END AS alert_type,
    CASE WHEN monthly_return_pct >= {strong} OR monthly_return_pct <= -{strong} THEN 'HIGH'
         WHEN monthly_return_pct >= {momentum} OR monthly_return_pct <= -{momentum} THEN 'MEDIUM' END AS alert_severity
  FROM {src}
)
SELECT symbol, month_start_date, ROUND(monthly_return_pct, 2) AS monthly_return_pct, alert_type, alert_severity,
  symbol || ' had a ' || alert_type || ' signal in ' || CAST(month_start_date AS VARCHAR)
    || ' with a monthly return of ' || CAST(ROUND(monthly_return_pct, 2) AS VARCHAR) || '%.' AS alert_message
FROM ar WHERE alert_type IS NOT NULL
"""


def core_sql() -> dict[str, str]:
    return {
        "bars_daily": with_ctes(BARS, body="SELECT * FROM bars"),
        "silver_prices": with_ctes(BARS, silver_cte(), body=f"SELECT {SILVER_COLS} FROM silver"),
        "long_term_performance": with_ctes(BARS, silver_cte(), body="""
SELECT symbol, start_date, first_adjusted_closing_price, end_date, latest_adjusted_closing_price,
  latest_adjusted_closing_price - first_adjusted_closing_price AS total_return,
  (latest_adjusted_closing_price / NULLIF(first_adjusted_closing_price, 0) - 1) * 100 AS total_return_pct
FROM (SELECT symbol, MIN(price_date) AS start_date, MAX(price_date) AS end_date,
             arg_min(adjusted_closing_price, price_date) AS first_adjusted_closing_price,
             arg_max(adjusted_closing_price, price_date) AS latest_adjusted_closing_price
      FROM silver GROUP BY symbol) t
"""),
        "long_term_performance_join_form": with_ctes(*mart_ctes(), body="SELECT * FROM long_term"),
        "monthly_performance": with_ctes(*STD, body=f"SELECT {MONTHLY_COLS} FROM monthly"),
        "monthly_performance_join_form": with_ctes(*STD, body=f"SELECT {MONTHLY_COLS} FROM monthly"),
        "monthly_market_summary": "WITH " + ",".join(STD) + market_summary_body(),
        "risk_summary": "WITH " + ",".join(STD) + risk_body(),
        "alert_candidates": "WITH " + ",".join(STD) + alerts_body(),
        "top_k_per_month": "WITH " + ",".join(STD) + """
, r AS (SELECT month_start_date, symbol, monthly_return_pct,
          CAST(ROW_NUMBER() OVER (PARTITION BY month_start_date
               ORDER BY monthly_return_pct DESC NULLS LAST, symbol ASC) AS INTEGER) AS rank_in_month
        FROM monthly)
SELECT month_start_date, rank_in_month, symbol, ROUND(monthly_return_pct, 2) AS monthly_return_pct
FROM r WHERE rank_in_month <= 3
""",
    }



def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def mart_ctes() -> tuple[str, ...]:
    """bars, silver, monthly plus every mart as a named CTE (for the data checks)."""
    lt = """
long_term AS (
  SELECT symbol, start_date, first_adjusted_closing_price, end_date, latest_adjusted_closing_price,
    latest_adjusted_closing_price - first_adjusted_closing_price AS total_return,
    (latest_adjusted_closing_price / NULLIF(first_adjusted_closing_price, 0) - 1) * 100 AS total_return_pct
  FROM (SELECT symbol, MIN(price_date) AS start_date, MAX(price_date) AS end_date,
               arg_min(adjusted_closing_price, price_date) AS first_adjusted_closing_price,
               arg_max(adjusted_closing_price, price_date) AS latest_adjusted_closing_price
        FROM silver GROUP BY symbol) t
)"""
    ms = "market_summary AS (" + market_summary_body().replace(", ms AS", "WITH ms AS", 1) + ")"
    rk = "risk AS (" + risk_body().replace(", rs AS", "WITH rs AS", 1) + ")"
    al = "alerts AS (" + alerts_body().replace(", ar AS", "WITH ar AS", 1) + ")"
    return (*STD, lt, ms, rk, al)


def _report_sql(check: str, table: str, column: str, failed: str, src: str) -> str:
    return (f"SELECT {_q(check)} AS \"check\", {_q(table)} AS table_name, {_q(column)} AS column_name, "
            f"CAST({failed} AS BIGINT) AS failed_rows FROM {src}")


def _not_null_sql(table: str, cols: list[str]) -> list[str]:
    return [_report_sql("not_null", table, c, f"COUNT(*) FILTER (WHERE {c} IS NULL)", table if table != "bronze" else "bars")
            for c in cols]


def _unique_sql(table: str, src: str, cols: list[str], check: str) -> str:
    keys = ", ".join(cols)
    nn = "TRUE" if check == "composite_key" else " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return _report_sql(check, table, ",".join(cols), "COUNT(*)",
                       f"(SELECT {keys} FROM {src} WHERE {nn} GROUP BY {keys} HAVING COUNT(*) > 1) d")


def _accepted_sql(table: str, col: str, values) -> str:
    return _report_sql("accepted_values", table, col,
                       f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({_in_list(values)}))", table)


REF = "(SELECT MAX(price_date) FROM silver)"


def _snapshot_cte() -> str:
    return f"""
syms AS (
  SELECT symbol, MAX(price_date) AS latest_date,
         arg_max(adjusted_closing_price, price_date) AS latest_adjusted_close,
         CAST({REF} - INTERVAL 30 DAY AS DATE) AS target
  FROM silver GROUP BY symbol
),
snap AS (
  SELECT t.symbol, b.price_date AS base_date, b.adjusted_closing_price AS base_adjusted_close,
    t.latest_date, t.latest_adjusted_close,
    CASE WHEN b.adjusted_closing_price IS NULL OR b.adjusted_closing_price = 0 THEN NULL
         ELSE ((t.latest_adjusted_close / b.adjusted_closing_price) - 1) * 100 END AS return_pct
  FROM syms t ASOF LEFT JOIN silver b ON t.symbol = b.symbol AND t.target >= b.price_date
)"""


def _horizon_sql() -> str:
    last = """
hl AS (
  SELECT symbol, MAX(price_date) AS latest_date,
    arg_max(adjusted_closing_price, price_date) AS latest_adjusted_close,
    arg_max(previous_adjusted_closing_price, price_date) AS b_1d,
    arg_max(adjusted_close_5d_ago, price_date) AS b_1w,
    arg_min(adjusted_closing_price, price_date) AS b_max
  FROM silver GROUP BY symbol
)"""
    parts = []
    order = ["1D", "1W", "1M", "3M", "6M", "YTD", "1Y", "3Y", "5Y", "MAX"]
    months = {"1M": 1, "3M": 3, "6M": 6, "1Y": 12, "3Y": 36, "5Y": 60}
    for i, h in enumerate(order):
        if h in ("1D", "1W", "MAX"):
            col = {"1D": "b_1d", "1W": "b_1w", "MAX": "b_max"}[h]
            parts.append(f"SELECT symbol, '{h}' AS horizon, {i} AS horizon_order, latest_date, "
                         f"latest_adjusted_close, {col} AS base_adjusted_close FROM hl")
            continue
        if h == "YTD":
            target = f"CAST(date_trunc('year', {REF}) - INTERVAL 1 DAY AS DATE)"
        else:
            target = f"CAST({REF} - INTERVAL {months[h]} MONTH AS DATE)"
        parts.append(
            f"SELECT t.symbol, '{h}' AS horizon, {i} AS horizon_order, t.latest_date, t.latest_adjusted_close, "
            f"b.adjusted_closing_price AS base_adjusted_close "
            f"FROM (SELECT *, {target} AS target FROM hl) t ASOF LEFT JOIN silver b "
            f"ON t.symbol = b.symbol AND t.target >= b.price_date")
    body = "\nUNION ALL\n".join(parts)
    return ("WITH " + ",".join((BARS, silver_cte(), last)) + f"""
, hz AS ({body})
SELECT symbol, horizon, CAST(horizon_order AS INTEGER) AS horizon_order, latest_date, latest_adjusted_close,
  base_adjusted_close,
  CASE WHEN base_adjusted_close IS NULL OR base_adjusted_close = 0 THEN NULL
       ELSE ((latest_adjusted_close / base_adjusted_close) - 1) * 100 END AS return_pct
FROM hz""")


BRONZE_COLS = ("symbol, price_date, open, high, low, close, adjusted_close, volume, source_provider, "
               "load_type, batch_id, ingested_at_utc")


def _drops_cte(drop_b, drop_b_symbols) -> str:
    return f"""
drops AS (
  SELECT * FROM bars
  UNION ALL
  SELECT * FROM bars WHERE price_date >= DATE '{drop_b[0]}' AND price_date < DATE '{drop_b[1]}'
    AND symbol IN ({_in_list(drop_b_symbols)})
)"""


NULL_REQUIRED = ("(price_date IS NULL OR open IS NULL OR isnan(open) OR high IS NULL OR isnan(high) "
                 "OR low IS NULL OR isnan(low) OR close IS NULL OR isnan(close) "
                 "OR adjusted_close IS NULL OR isnan(adjusted_close) OR volume IS NULL)")


def more_sql() -> dict[str, str]:
    from barmarts.plans import registry as R
    std = "WITH " + ",".join(STD)
    marts = "WITH " + ",".join(mart_ctes())
    upsert_sql = "WITH " + BARS + f"""
, target AS (SELECT * FROM bars WHERE price_date < DATE '{R.UPSERT_TARGET_BEFORE}'),
batch AS (SELECT symbol, price_date, open, high, low, close, adjusted_close * 2 AS adjusted_close, volume,
                 source_provider, 'incremental' AS load_type, batch_id, ingested_at_utc
          FROM bars WHERE price_date >= DATE '{R.UPSERT_BATCH_FROM}')
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.symbol = t.symbol AND b.price_date = t.price_date)
UNION ALL
SELECT * FROM batch"""
    drops = "WITH " + BARS + "," + _drops_cte(R.DROP_B, R.DROP_B_SYMBOLS)
    snap = "WITH " + ",".join((BARS, silver_cte(), _snapshot_cte()))
    lk = ", ".join(R.LINEITEM_KEY)
    heat = ", ".join(
        f"ROUND(AVG(monthly_return_pct) FILTER (WHERE month(month_start_date) = {m}), 2) AS m{m:02d}"
        for m in range(1, 13))
    from barmarts.schemas import (ALERT_COLUMNS, LONG_TERM_COLUMNS, MARKET_SUMMARY_COLUMNS,
                                  MONTHLY_COLUMNS, RISK_COLUMNS, SILVER_COLUMNS, SILVER_NULLABLE)
    nn = (_not_null_sql("bronze", ["symbol", "price_date", "adjusted_close", "volume"])
          + _not_null_sql("silver", [c for c in SILVER_COLUMNS if c not in SILVER_NULLABLE])
          + _not_null_sql("long_term", LONG_TERM_COLUMNS) + _not_null_sql("monthly", MONTHLY_COLUMNS)
          + _not_null_sql("risk", RISK_COLUMNS) + _not_null_sql("market_summary", MARKET_SUMMARY_COLUMNS)
          + _not_null_sql("alerts", ALERT_COLUMNS)
          # audit stamps are written with every row
          + [f"SELECT 'not_null', {_q(t)}, {_q(c)}, CAST(0 AS BIGINT)" for t, c in
             [("silver", "silver_created_at_utc")] + [(t, "gold_created_at_utc") for t in
              ("long_term", "monthly", "risk", "market_summary", "alerts")]])
    return {
        "table_profile": "WITH " + BARS + """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT symbol) AS total_symbols,
       MIN(price_date) AS earliest_date, MAX(price_date) AS latest_date FROM bars""",
        "profile_by_symbol": "WITH " + BARS + """
, pk AS (SELECT symbol, price_date, COUNT(*) AS n FROM bars GROUP BY symbol, price_date)
SELECT symbol, CAST(SUM(n) AS BIGINT) AS row_count, MIN(price_date) AS min_date, MAX(price_date) AS max_date,
       CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
FROM pk GROUP BY symbol""",
        "duplicate_keys": f"SELECT {lk}, COUNT(*) AS row_count FROM lineitem GROUP BY {lk} HAVING COUNT(*) > 1",
        "duplicate_row_count": f"""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows,
       COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY {lk}) g""",
        "upsert_bars": upsert_sql,
        "newest_bar_per_symbol": "WITH " + BARS + f"""
SELECT {BRONZE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY price_date DESC) AS rn FROM bars) r
WHERE rn = 1""",
        "history_since": "WITH " + BARS + f" SELECT * FROM bars WHERE price_date >= DATE '{R.HISTORY_START}'",
        "normalise_landing": "WITH " + BARS + """
SELECT symbol, price_date, open, high, low, close, adjusted_close, volume,
       'yahoo_finance' AS source_provider, 'historical' AS load_type, 'batch-1' AS batch_id,
       TIMESTAMP '2024-01-02 00:00:00' AS ingested_at_utc
FROM bars""",
        "bars_with_dimension": "WITH " + BARS + """
, dim AS (SELECT p_brand AS symbol, MIN(p_type) AS asset_class, MIN(p_name) AS name FROM part GROUP BY p_brand)
SELECT b.*, d.asset_class, d.name FROM bars b LEFT JOIN dim d ON b.symbol = d.symbol""",
        "snapshot_30d": snap + " SELECT * FROM snap",
        "snapshot_kpis": snap + """
SELECT COUNT(*) AS symbols_count, COUNT(return_pct) AS symbols_with_return,
  ROUND(AVG(return_pct), 2) AS avg_return_pct,
  CAST(ROUND(SUM(CASE WHEN return_pct > 0 THEN 1 ELSE 0 END) * 100.0 / NULLIF(COUNT(return_pct), 0), 2) AS DOUBLE)
    AS positive_pct,
  (SELECT symbol FROM snap WHERE return_pct IS NOT NULL ORDER BY return_pct DESC, symbol LIMIT 1) AS best_symbol,
  ROUND(MAX(return_pct), 2) AS best_return_pct,
  (SELECT symbol FROM snap WHERE return_pct IS NOT NULL ORDER BY return_pct ASC, symbol LIMIT 1) AS worst_symbol,
  ROUND(MIN(return_pct), 2) AS worst_return_pct,
  MAX(latest_date) AS latest_date
FROM snap""",
        "return_ranking": snap + """
SELECT symbol, return_pct,
  CAST(row_number() OVER (ORDER BY return_pct DESC NULLS LAST, symbol ASC) AS INTEGER) AS return_rank
FROM snap""",
        "freshness": "WITH " + ",".join((BARS, silver_cte())) + f"""
SELECT MAX(price_date) AS latest_price_date, COUNT(DISTINCT symbol) AS total_symbols,
  COUNT(DISTINCT CASE WHEN price_date = {REF} THEN symbol END) AS symbols_at_latest_date
FROM silver""",
        "horizon_returns": _horizon_sql(),
        "horizon_ranking": f"""
SELECT symbol, horizon, return_pct,
  CAST(row_number() OVER (ORDER BY return_pct DESC NULLS LAST, symbol) AS INTEGER) AS return_rank
FROM ({_horizon_sql()}) h WHERE horizon = '{R.RANKING_HORIZON}'""",
        "asof_join_events": """
WITH clicks AS (SELECT event_id AS click_event_id, user_id, ts AS click_ts, value AS click_value
                FROM events WHERE event_type = 'click'),
views AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'view')
SELECT c.click_event_id, c.user_id, c.click_ts, c.click_value,
       v.ts AS view_ts, v.event_id AS view_event_id, v.value AS view_value
FROM clicks c ASOF LEFT JOIN views v ON c.user_id = v.user_id AND c.click_ts >= v.ts""",
        "growth_of_100": "WITH " + ",".join((BARS, silver_cte())) + f"""
, g AS (SELECT symbol, price_date, adjusted_closing_price FROM silver
        WHERE price_date >= CAST({REF} - INTERVAL 12 MONTH AS DATE))
SELECT symbol, price_date,
  FIRST_VALUE(price_date) OVER (PARTITION BY symbol ORDER BY price_date) AS base_date,
  adjusted_closing_price,
  CASE WHEN FIRST_VALUE(adjusted_closing_price) OVER (PARTITION BY symbol ORDER BY price_date) = 0 THEN NULL
       ELSE adjusted_closing_price * 100
            / FIRST_VALUE(adjusted_closing_price) OVER (PARTITION BY symbol ORDER BY price_date) END AS growth_of_100
FROM g""",
        "seasonality_heatmap": std + f" SELECT symbol, {heat} FROM monthly GROUP BY symbol",
        "seasonality_leaders": std + """
, st AS (
  SELECT CAST(month(month_start_date) AS INTEGER) AS calendar_month,
    COUNT(monthly_return_pct) AS observations,
    ROUND(AVG(monthly_return_pct), 2) AS avg_return_pct,
    CAST(ROUND(SUM(CASE WHEN monthly_return_pct > 0 THEN 1 ELSE 0 END) * 100.0
               / NULLIF(COUNT(monthly_return_pct), 0), 2) AS DOUBLE) AS positive_ratio_pct
  FROM monthly GROUP BY 1)
SELECT *,
  calendar_month = (SELECT calendar_month FROM st ORDER BY avg_return_pct DESC, calendar_month LIMIT 1) AS is_highest_average,
  calendar_month = (SELECT calendar_month FROM st ORDER BY avg_return_pct ASC, calendar_month LIMIT 1) AS is_lowest_average,
  calendar_month = (SELECT calendar_month FROM st ORDER BY positive_ratio_pct DESC, calendar_month LIMIT 1) AS is_most_often_positive
FROM st""",
        "dq_not_null": marts + "\n" + "\nUNION ALL\n".join(nn),
        "dq_unique": marts + "\n" + "\nUNION ALL\n".join([
            _unique_sql("long_term", "long_term", ["symbol"], "unique"),
            _unique_sql("risk", "risk", ["symbol"], "unique"),
            _unique_sql("market_summary", "market_summary", ["month_start_date"], "unique")]),
        "dq_accepted_values": marts + "\n" + "\nUNION ALL\n".join([
            _accepted_sql("silver", "symbol", R.ACCEPTED_SYMBOLS),
            _accepted_sql("silver", "source_provider", R.ACCEPTED_PROVIDERS),
            _accepted_sql("silver", "data_loaded_as", ["historical", "incremental"]),
            _accepted_sql("alerts", "alert_type", ["STRONG_GAIN", "SHARP_DROP", "POSITIVE_MOMENTUM",
                                                   "NEGATIVE_MOMENTUM"]),
            _accepted_sql("alerts", "alert_severity", ["HIGH", "MEDIUM"])]),
        "dq_composite_key": std + "\n" + "\nUNION ALL\n".join([
            _unique_sql("bronze", "bars", ["symbol", "price_date"], "composite_key"),
            _unique_sql("silver", "silver", ["symbol", "price_date"], "composite_key"),
            _unique_sql("monthly", "monthly", ["symbol", "month_start_date"], "composite_key"),
            _unique_sql("lineitem", "lineitem", R.LINEITEM_KEY, "composite_key")]),
        "dq_recompute": std + "\n" + _report_sql(
            "recompute", "monthly", "monthly_return_pct", "COUNT(*)",
            "monthly WHERE first_adjusted_closing_price != 0 AND ABS(monthly_return_pct - "
            "(((last_adjusted_closing_price / first_adjusted_closing_price) - 1) * 100)) > 0.01"),
        "gate_report": drops + f"""
, g AS (
  SELECT 'no_duplicate_keys' AS gate, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS failed
  FROM (SELECT COUNT(*) AS n FROM drops GROUP BY symbol, price_date) k
  UNION ALL
  SELECT 'no_null_required', CAST(COUNT(*) FILTER (WHERE {NULL_REQUIRED}) AS BIGINT) FROM drops
  UNION ALL
  SELECT 'not_empty', CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM drops
  UNION ALL
  SELECT 'all_symbols_present', CAST(COUNT(*) AS BIGINT)
  FROM (SELECT DISTINCT p_brand AS symbol FROM part) u
  WHERE NOT EXISTS (SELECT 1 FROM drops d WHERE d.symbol = u.symbol)
)
SELECT gate, failed, failed = 0 AS passed FROM g""",
        "split_rejects": drops + f"""
, dup AS (SELECT symbol, price_date FROM drops GROUP BY symbol, price_date HAVING COUNT(*) > 1),
r AS (
  SELECT d.*, CASE WHEN {NULL_REQUIRED.replace('(price_date', '(d.price_date').replace(' open', ' d.open')} THEN 'null_required'
                   WHEN dup.symbol IS NOT NULL THEN 'duplicate_key' END AS fault
  FROM drops d LEFT JOIN dup ON d.symbol = dup.symbol AND d.price_date = dup.price_date
),
bad AS (SELECT DISTINCT symbol FROM r WHERE fault IS NOT NULL),
f AS (
  SELECT r.*, COALESCE(r.fault, CASE WHEN bad.symbol IS NOT NULL THEN 'symbol_failed' END) AS reject_reason
  FROM r LEFT JOIN bad ON r.symbol = bad.symbol
)
SELECT {BRONZE_COLS}, CASE WHEN reject_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status,
       reject_reason
FROM f""",
        "data_tests": marts + "\n, report AS (\n" + "\nUNION ALL\n".join(
            nn
            + [_unique_sql("long_term", "long_term", ["symbol"], "unique"),
               _unique_sql("risk", "risk", ["symbol"], "unique"),
               _unique_sql("market_summary", "market_summary", ["month_start_date"], "unique"),
               _accepted_sql("silver", "symbol", R.ACCEPTED_SYMBOLS),
               _accepted_sql("silver", "source_provider", R.ACCEPTED_PROVIDERS),
               _accepted_sql("silver", "data_loaded_as", ["historical", "incremental"]),
               _accepted_sql("alerts", "alert_type", ["STRONG_GAIN", "SHARP_DROP", "POSITIVE_MOMENTUM",
                                                      "NEGATIVE_MOMENTUM"]),
               _accepted_sql("alerts", "alert_severity", ["HIGH", "MEDIUM"]),
               _unique_sql("bronze", "bars", ["symbol", "price_date"], "composite_key"),
               _unique_sql("silver", "silver", ["symbol", "price_date"], "composite_key"),
               _unique_sql("monthly", "monthly", ["symbol", "month_start_date"], "composite_key"),
               _report_sql("recompute", "monthly", "monthly_return_pct", "COUNT(*)",
                           "monthly WHERE first_adjusted_closing_price != 0 AND ABS(monthly_return_pct - "
                           "(((last_adjusted_closing_price / first_adjusted_closing_price) - 1) * 100)) > 0.01")])
        + "\n)\nSELECT *, failed_rows = 0 AS passed FROM report",
        "partitioned_landing_roundtrip": "WITH " + BARS + " SELECT * FROM bars",
        "landing_profile": "WITH " + BARS + """
, pk AS (SELECT symbol, price_date, COUNT(*) AS n FROM bars GROUP BY symbol, price_date)
SELECT symbol, CAST(SUM(n) AS BIGINT) AS row_count, MIN(price_date) AS min_date, MAX(price_date) AS max_date,
       CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
FROM pk GROUP BY symbol""",
        "stream_upsert": upsert_sql,
        "historical_backfill": "WITH " + BARS + """
SELECT symbol, price_date, open, high, low, close, adjusted_close, volume,
       'yahoo_finance' AS source_provider, 'historical' AS load_type, 'batch-1' AS batch_id,
       TIMESTAMP '2024-01-02 00:00:00' AS ingested_at_utc
FROM bars""",
        "incremental_daily": "WITH " + BARS + f"""
, target AS (SELECT * FROM bars WHERE price_date < DATE '{R.UPSERT_TARGET_BEFORE}'),
newest AS (
  SELECT symbol, price_date, open, high, low, close, adjusted_close, volume,
         'yahoo_finance' AS source_provider, 'incremental' AS load_type, 'batch-2' AS batch_id,
         TIMESTAMP '2024-01-03 00:00:00' AS ingested_at_utc
  FROM bars
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY price_date DESC) = 1
)
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.symbol = t.symbol AND n.price_date = t.price_date)
UNION ALL
SELECT * FROM newest""",
        "materialised_alerts": "WITH " + ",".join(STD) + alerts_body(),
        "dimension_file_join": "WITH " + BARS + """
, dim AS (SELECT p_brand AS symbol, MIN(p_name) AS name, MIN(p_type) AS asset_class, MIN(substr(p_type, 1, 3)) AS region,
                 CAST(MAX(p_size) AS VARCHAR) AS category FROM part GROUP BY p_brand)
SELECT b.*, d.name, d.asset_class, d.region, d.category FROM bars b LEFT JOIN dim d ON b.symbol = d.symbol""",
        "missing_from_universe": "WITH " + BARS + f"""
SELECT u.symbol FROM (SELECT unnest([{_in_list([*R.ACCEPTED_SYMBOLS, *R.DEFAULT_UNIVERSE])}]) AS symbol) u
WHERE u.symbol NOT IN (SELECT symbol FROM bars)""",
        "monthly_positions": with_ctes(*STD, body="""SELECT symbol, month_start_date, monthly_return_pct,
  CAST(row_number() OVER (ORDER BY symbol, month_start_date) AS INTEGER) AS position FROM monthly"""),
        "alert_positions": f"""SELECT symbol, month_start_date, alert_type,
  CAST(row_number() OVER (ORDER BY month_start_date DESC, symbol) AS INTEGER) AS position
FROM (WITH {",".join(STD)} {alerts_body()}) al""",
    }


def all_sql() -> dict[str, str]:
    from barmarts.plans.stored_queries import stored_sql
    out = {}
    out.update(core_sql())
    out.update(more_sql())
    out.update(stored_sql())
    return out
