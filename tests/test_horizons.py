"""Dashboard queries on small fixtures: on-or-before bases across gaps, symbols younger
than the horizon, YTD, growth of 100, ties, seasonality picks."""
import datetime as dt

from pyspark.sql import functions as F

from barmarts.operators import gold, horizons, quality, seasonality
from barmarts.operators.silver import silver
from barmarts.schemas import BRONZE

D = dt.date.fromisoformat


def _bronze(spark, series):
    rows = []
    for sym, pts in series.items():
        for day, adj in pts:
            rows.append((sym, D(day), 1.0, 2.0, 0.5, 1.0, float(adj), 10, "synthetic", "historical", "b",
                         dt.datetime(2024, 1, 1)))
    return spark.createDataFrame(rows, BRONZE)


SERIES = {
    # gap: nothing between 2024-03-01 and 2024-04-20; ref = 2024-04-30, target = 2024-03-31
    "GAP": [("2023-06-30", 50), ("2023-12-29", 80), ("2024-01-31", 90), ("2024-03-01", 100),
            ("2024-04-20", 110), ("2024-04-24", 111), ("2024-04-25", 112), ("2024-04-26", 113),
            ("2024-04-29", 114), ("2024-04-30", 120)],
    # younger than 30 days: no bar on or before the target
    "NEW": [("2024-04-10", 10), ("2024-04-30", 12)],
}


def test_snapshot_on_or_before_and_young_symbol(spark):
    snap = {r.symbol: r for r in horizons.snapshot_30d(silver(_bronze(spark, SERIES))).collect()}
    assert snap["GAP"].base_date == D("2024-03-01") and snap["GAP"].base_adjusted_close == 100
    assert abs(snap["GAP"].return_pct - 20.0) < 1e-9
    assert snap["NEW"].base_date is None and snap["NEW"].return_pct is None
    k = horizons.snapshot_kpis(horizons.snapshot_30d(silver(_bronze(spark, SERIES)))).first()
    assert (k.symbols_count, k.symbols_with_return, k.best_symbol, k.worst_symbol) == (2, 1, "GAP", "GAP")
    assert k.positive_pct == 100.0
    rank = {r.symbol: r.return_rank for r in
            horizons.return_ranking(horizons.snapshot_30d(silver(_bronze(spark, SERIES)))).collect()}
    assert rank == {"GAP": 1, "NEW": 2}  # NULL return ranks last


def test_horizon_rules(spark):
    h = {(r.symbol, r.horizon): r for r in horizons.horizon_returns(silver(_bronze(spark, SERIES))).collect()}
    assert h[("GAP", "1D")].base_adjusted_close == 114
    assert h[("GAP", "1W")].base_adjusted_close == 110   # five rows back: 04-20
    assert h[("GAP", "1M")].base_adjusted_close == 100   # on or before 2024-03-30
    assert h[("GAP", "3M")].base_adjusted_close == 80    # on or before 2024-01-30 -> 2023-12-29
    assert h[("GAP", "YTD")].base_adjusted_close == 80   # last bar before 1 January
    assert h[("GAP", "1Y")].base_adjusted_close is None  # target 2023-04-30 precedes the first bar
    assert h[("GAP", "MAX")].base_adjusted_close == 50
    assert h[("NEW", "1M")].return_pct is None and h[("NEW", "MAX")].base_adjusted_close == 10
    assert h[("NEW", "1W")].base_adjusted_close is None


def test_growth_of_100(spark):
    g = horizons.growth_of_100(silver(_bronze(spark, SERIES)), symbols=["GAP", "NEW"], months=1)
    firsts = {r.symbol: r.growth_of_100 for r in g.where(F.col("price_date") == F.col("base_date")).collect()}
    assert firsts == {"GAP": 100.0, "NEW": 100.0}
    assert g.where("symbol = 'GAP'").agg(F.max("growth_of_100")).first()[0] == 120.0 * 100 / 110


def test_ties_break_by_symbol(spark):
    series = {"BBB": [("2024-01-02", 10), ("2024-01-31", 11)],
              "AAA": [("2024-01-02", 20), ("2024-01-31", 22)],
              "CCC": [("2024-01-02", 10), ("2024-01-31", 9)],
              "DDD": [("2024-01-02", 20), ("2024-01-31", 18)]}
    m = gold.monthly_performance(silver(_bronze(spark, series)))
    r = gold.monthly_market_summary(m).first()
    assert (r.best_performing_etf, r.worst_performing_etf) == ("AAA", "CCC")
    top = [x.symbol for x in gold.top_k_per_month(m, k=3).orderBy("rank_in_month").collect()]
    assert top == ["AAA", "BBB", "CCC"]


def test_seasonality(spark):
    series = {"AAA": [("2023-01-02", 10), ("2023-01-31", 11), ("2023-02-01", 10), ("2023-02-28", 9),
                      ("2024-01-02", 10), ("2024-01-31", 10.5)],
              "BBB": [("2023-01-02", 10), ("2023-01-31", 9), ("2023-02-01", 10), ("2023-02-28", 11)]}
    m = gold.monthly_performance(silver(_bronze(spark, series)))
    heat = {r.symbol: (r.m01, r.m02, r.m03) for r in seasonality.seasonality_heatmap(m).collect()}
    assert heat["AAA"] == (7.5, -10.0, None) and heat["BBB"] == (-10.0, 10.0, None)
    lead = {r.calendar_month: r for r in seasonality.seasonality_leaders(m).collect()}
    assert lead[1].avg_return_pct == round((10 + 5 - 10) / 3, 2) and lead[2].avg_return_pct == 0.0
    assert lead[1].is_highest_average and lead[2].is_lowest_average
    assert lead[1].is_most_often_positive  # 2 of 3 positive vs 1 of 2


def test_accepted_values_provider_and_load_type(spark):
    df = _bronze(spark, SERIES).withColumn("source_provider", F.lit("other_vendor"))
    s = silver(df)
    assert quality.accepted_values_report(s, "silver", "source_provider", ["yahoo_finance"]).first().failed_rows == 12
    assert quality.accepted_values_report(s, "silver", "data_loaded_as", ["historical", "incremental"]).first().failed_rows == 0


def test_leaders_match_rank_windows_with_nan_and_null(spark):
    from pyspark.sql import Window
    rows = [("2024-01-01", "A", 5.0), ("2024-01-01", "B", float("nan")), ("2024-01-01", "C", None),
            ("2024-01-01", "D", 5.0), ("2024-02-01", "A", None), ("2024-02-01", "B", -1.0),
            ("2024-03-01", "C", float("nan")), ("2024-03-01", "A", float("nan"))]
    m = spark.createDataFrame([(D(d), s, p) for d, s, p in rows],
                              "month_start_date date, symbol string, monthly_return_pct double")
    got = {r.month_start_date: (r.best_performing_etf, r.worst_performing_etf)
           for r in gold.monthly_market_summary(m).collect()}
    pct = F.col("monthly_return_pct")
    best = Window.partitionBy("month_start_date").orderBy(pct.desc(), F.col("symbol"))
    worst = Window.partitionBy("month_start_date").orderBy(pct.asc(), F.col("symbol"))
    ref = (m.withColumn("b", F.row_number().over(best)).withColumn("w", F.row_number().over(worst)))
    exp_b = {r.month_start_date: r.symbol for r in ref.where("b = 1").collect()}
    exp_w = {r.month_start_date: r.symbol for r in ref.where("w = 1").collect()}
    assert got == {k: (exp_b[k], exp_w[k]) for k in exp_b}


def test_growth_of_100_horizons(spark):
    s = silver(_bronze(spark, SERIES))
    ytd = horizons.growth_of_100(s, ["GAP"], horizon="YTD")
    assert ytd.agg(F.min("base_date")).first()[0] == D("2024-01-31")
    mx = horizons.growth_of_100(s, ["GAP"], horizon="MAX")
    assert mx.count() == len(SERIES["GAP"]) and mx.agg(F.min("base_date")).first()[0] == D("2023-06-30")
    assert horizons.growth_of_100(s, ["GAP"], horizon="1M").agg(F.min("base_date")).first()[0] == D("2024-04-20")


def test_seasonality_since(spark):
    series = {"AAA": [("2023-01-02", 10), ("2023-01-31", 11), ("2024-01-02", 10), ("2024-01-31", 10.5)]}
    m = gold.monthly_performance(silver(_bronze(spark, series)))
    assert seasonality.seasonality_heatmap(m, since="2024-01-01").first().m01 == 5.0
    assert seasonality.seasonality_leaders(m, since="2024-01-01").first().observations == 1
