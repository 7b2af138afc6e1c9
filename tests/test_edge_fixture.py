"""FIXTURES.md section 3: the edge bars and their hand-checked expected rows."""
import datetime as dt

import pytest

from barmarts.operators import gold
from barmarts.operators.silver import silver

D = dt.date.fromisoformat


def _rows(df, *cols):
    return {tuple(r[c] for c in cols[:2]): tuple(r[c] for c in cols[2:]) for r in df.collect()}


@pytest.mark.parametrize("split_by", [None, "month"])
def test_silver_edge(edge_bronze, split_by):
    s = silver(edge_bronze, split_by=split_by)
    assert s.count() == 14
    got = _rows(s, "symbol", "price_date", "trading_day_number", "daily_return_pct", "return_5d_pct")
    assert got[("AAA", D("2024-01-05"))] == (3, -1.9802, None)
    assert got[("AAA", D("2024-01-10"))] == (6, 6.7961, 10.0)
    assert got[("AAA", D("2024-02-29"))] == (8, 7.996, -45.4566)
    assert got[("BBB", D("2024-02-01"))] == (2, -100.0, None)
    assert got[("BBB", D("2024-02-20"))] == (3, None, None)  # previous close 0 -> NULL


def test_monthly_edge(edge_bronze):
    m = gold.monthly_performance(silver(edge_bronze))
    got = _rows(m, "symbol", "month_start_date", "first_adjusted_closing_price",
                "last_adjusted_closing_price", "monthly_return_pct", "trading_days_count")
    assert got == {
        ("AAA", D("2024-01-01")): (100.0, 110.0, 10.000000000000009, 6),
        ("AAA", D("2024-02-01")): (50.0, 53.998, 7.996000000000003, 2),
        ("BBB", D("2024-01-01")): (20.0, 20.0, 0.0, 1),
        ("BBB", D("2024-02-01")): (0.0, 5.0, None, 3),
        ("CCC", D("2024-01-01")): (10.0, 9.2, -8.000000000000007, 2),
    }


def test_market_summary_edge(edge_bronze):
    ms = {r["month_start_date"]: r for r in
          gold.monthly_market_summary(gold.monthly_performance(silver(edge_bronze))).collect()}
    jan, feb = ms[D("2024-01-01")], ms[D("2024-02-01")]
    assert (jan.total_etfs_count, jan.positive_etfs_count, jan.negative_etfs_count, jan.flat_etfs_count) == (3, 1, 1, 1)
    assert (jan.avg_monthly_return_pct, jan.best_monthly_return_pct, jan.worst_monthly_return_pct) == (0.67, 10.0, -8.0)
    assert (jan.best_performing_etf, jan.worst_performing_etf, jan.positive_etf_ratio_pct) == ("AAA", "CCC", 33.33)
    assert (feb.total_etfs_count, feb.positive_etfs_count, feb.negative_etfs_count, feb.flat_etfs_count) == (2, 1, 0, 0)
    assert (feb.avg_monthly_return_pct, feb.best_monthly_return_pct, feb.worst_monthly_return_pct) == (8.0, 8.0, 8.0)
    # NULL return ranks worst (ASC puts NULL first); its pct column is NULL
    assert (feb.best_performing_etf, feb.worst_performing_etf) == ("AAA", "BBB")
    assert feb.worst_performing_etf_return_pct is None
    assert feb.positive_etf_ratio_pct == 50.0


def test_risk_edge(edge_bronze):
    r = {x.symbol: x for x in gold.risk_summary(gold.monthly_performance(silver(edge_bronze))).collect()}
    key = lambda x: (x.total_months_count, x.avg_monthly_return_pct, x.monthly_volatility_pct, x.return_to_risk_score)
    assert key(r["AAA"]) == (2, 9.0, 1.42, 6.34)
    assert key(r["BBB"]) == (2, 0.0, None, None)
    assert key(r["CCC"]) == (1, -8.0, None, None)


def test_alerts_edge(edge_bronze):
    a = gold.alert_candidates(gold.monthly_performance(silver(edge_bronze)))
    got = {(x.symbol, x.month_start_date): (x.alert_type, x.alert_severity, x.monthly_return_pct, x.alert_message)
           for x in a.collect()}
    assert set(got) == {("AAA", D("2024-01-01")), ("AAA", D("2024-02-01")), ("CCC", D("2024-01-01"))}
    assert got[("AAA", D("2024-01-01"))][:3] == ("STRONG_GAIN", "HIGH", 10.0)
    assert got[("AAA", D("2024-02-01"))] == (
        "POSITIVE_MOMENTUM", "MEDIUM", 8.0,
        "AAA had a POSITIVE_MOMENTUM signal in 2024-02-01 with a monthly return of 8.0%.")
    assert got[("CCC", D("2024-01-01"))][:3] == ("SHARP_DROP", "HIGH", -8.0)


def test_long_term_edge(edge_bronze):
    lt = {x.symbol: x for x in gold.long_term_performance(silver(edge_bronze)).collect()}
    assert lt["AAA"].first_adjusted_closing_price == 100.0
    assert lt["AAA"].latest_adjusted_closing_price == 53.998
    assert lt["BBB"].total_return_pct == (5.0 / 20.0 - 1) * 100


def test_ordered_outputs(edge_bronze):
    m = gold.monthly_performance(silver(edge_bronze), ordered=True)
    keys = [(r.symbol, r.month_start_date) for r in m.collect()]
    assert keys == sorted(keys)
    a = gold.alert_candidates(gold.monthly_performance(silver(edge_bronze)), ordered=True)
    months = [r.month_start_date for r in a.collect()]
    assert months == sorted(months, reverse=True)
