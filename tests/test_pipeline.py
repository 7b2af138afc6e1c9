"""G7 / G8 end to end from landed vendor files, materialised marts, dimension file, MERGE."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from barmarts.operators.quality import GateError
from barmarts.operators.upsert import merge_into, read_bronze
from barmarts.plans.pipeline import build_marts, historical_load, incremental_load, materialise_marts
from barmarts.session import shared_dir
from barmarts.sources.landing import read_dimension, read_vendor_csv, universe_frame
from barmarts.sources.tables import bars_from_tables
from barmarts.operators.enrich import with_dimension
from conftest import SF_SMALL
from test_plans import physical_tree


def _vendor_rows(symbol, days, start=100.0):
    out = []
    for i, d in enumerate(days):
        p = start + i
        out.append((symbol, d, p, p + 1, p - 1, p, p, str(1000 + i)))
    return out


def _land(spark, rows, path):
    df = spark.createDataFrame(rows, "Symbol string, Date string, Open double, High double, Low double, "
                                     "Close double, `Adj Close` double, Volume string")
    df.write.mode("overwrite").option("header", True).csv(path)
    return read_vendor_csv(spark, path)


def test_historical_then_incremental(spark):
    root = shared_dir(spark, "test-pipeline")
    days = ["2024-01-02", "2024-01-03", "2024-01-04"]
    rows = _vendor_rows("AAA", days) + _vendor_rows("BBB", days, 50.0)
    twice = [("CCC", "2024-01-02", 1.0, 2.0, 0.5, 1.0, 1.0, "5")] * 2
    with pytest.raises(GateError, match="no_duplicate_keys=1"):  # duplicates refuse the whole batch
        historical_load(spark, _land(spark, rows + twice, f"{root}/dup"), f"{root}/bronze", "yahoo_finance", "b-0", "2024-01-05 00:00:00")
    rows += [("CCC", "2024-01-02", 1.0, 2.0, 0.5, 1.0, 1.0, "12x"), ("CCC", "2024-01-03", 1.0, 2.0, 0.5, 1.0, 1.0, "7"),
             ("AAA", "2014-12-31", 1.0, 2.0, 0.5, 1.0, 1.0, "5")]
    landed = _land(spark, rows, f"{root}/hist")
    report = historical_load(spark, landed, f"{root}/bronze", "yahoo_finance", "b-1", "2024-01-05 00:00:00",
                             start_date="2015-01-01", universe=universe_frame(spark, ["AAA", "BBB", "CCC", "DDD"]))
    # a value that does not cast rejects its symbol; a configured symbol without rows is reported
    assert {(r.symbol, r.reject_reason) for r in report.collect()} == {
        ("CCC", "cast_failed:volume"), ("CCC", "symbol_failed"), ("DDD", "nothing_returned")}
    table = read_bronze(spark, f"{root}/bronze")
    assert table.count() == 6
    # daily increment: newest bar per symbol; every configured symbol must be present
    inc = _land(spark, _vendor_rows("AAA", ["2024-01-04", "2024-01-05"], 200.0)
                + _vendor_rows("BBB", ["2024-01-05"], 300.0), f"{root}/inc")
    out = incremental_load(spark, inc, f"{root}/bronze", universe_frame(spark, ["AAA", "BBB"]),
                           "yahoo_finance", "b-2", "2024-01-06 00:00:00")
    got = {(r.symbol, r.price_date.day): (r.adjusted_close, r.load_type) for r in out.collect()}
    assert got[("AAA", 5)] == (201.0, "incremental")
    assert got[("AAA", 4)] == (102.0, "historical")  # only the newest bar is loaded
    assert got[("BBB", 5)] == (300.0, "incremental")
    with pytest.raises(GateError, match="missing symbols"):
        incremental_load(spark, inc, f"{root}/bronze", universe_frame(spark, ["AAA", "BBB", "ZZZ"]),
                         "yahoo_finance", "b-3", "2024-01-06 00:00:00")


def test_build_and_materialise_marts(spark):
    bars = bars_from_tables(spark, SF_SMALL)
    m = build_marts(bars)
    assert "silver_created_at_utc" in m.silver.columns
    assert all("gold_created_at_utc" in d.columns for d in (m.long_term, m.monthly, m.market_summary,
                                                              m.risk, m.alerts))
    written = materialise_marts(spark, bars, shared_dir(spark, "test-marts"))
    assert written["monthly"].count() == m.monthly.count()
    assert written["alerts"].count() == m.alerts.count()
    with pytest.raises(GateError, match="duplicated"):  # Q9 before Gold
        materialise_marts(spark, bars.unionByName(bars.limit(1)), shared_dir(spark, "test-marts-dup"))


def test_dimension_file_and_merge(spark):
    root = shared_dir(spark, "test-dim")
    dim = spark.createDataFrame([("Brand#1", "n1", "Equity", "US", "c")],
                                "symbol string, name string, asset_class string, region string, category string")
    dim.write.json(f"{root}/dim")
    d = read_dimension(spark, f"{root}/dim")
    out = with_dimension(bars_from_tables(spark, SF_SMALL), d)
    assert out.where(F.col("region") == "US").select("symbol").distinct().count() == 1
    assert out.count() == bars_from_tables(spark, SF_SMALL).count()  # left join keeps unknown symbols
    name = "merge_target_" + root.rsplit("/", 1)[-1][:8]
    spark.range(1).selectExpr("'A' AS symbol", "current_date() AS price_date").write.mode("overwrite") \
        .format("parquet").option("path", f"{root}/merge_target").saveAsTable(name)
    with pytest.raises(Exception, match="UNSUPPORTED"):  # no row-level MERGE on parquet: use upsert_into_path
        merge_into(spark, name, spark.table(name))
    spark.sql(f"DROP TABLE {name}")


def test_cluster_conf_bounds():
    from barmarts.session import cluster_conf
    big = cluster_conf(8000, input_tb=100)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 * 1024 // 512  # 512 MB a partition
    small = cluster_conf(64, input_tb=0.001)
    assert int(small["spark.sql.shuffle.partitions"]) == 192


def test_data_tests_suite(spark, edge_bronze):
    from barmarts.plans.pipeline import assert_data_tests, data_tests, stored_marts
    symbols = [f"Brand#{i}" for i in range(1, 26)]
    bars = bars_from_tables(spark, SF_SMALL)
    marts = materialise_marts(spark, bars, shared_dir(spark, "test-suite"))
    rep = data_tests(bars, marts, symbols, ["synthetic"])
    assert rep.count() == 81 and rep.where("check = 'not_null'").count() == 69
    assert_data_tests(rep)  # the derived bars pass every test
    # a corrupted stored table fails: the suite reads what is stored, it rebuilds nothing
    broken = dict(marts)
    broken["monthly"] = marts["monthly"].withColumn("monthly_return_pct", F.col("monthly_return_pct") + 1)
    broken["risk"] = marts["risk"].unionByName(marts["risk"].limit(1))
    broken["silver"] = marts["silver"].withColumn("silver_created_at_utc", F.lit(None).cast("timestamp_ntz"))
    broken["long_term"] = marts["long_term"].withColumn("symbol", F.lit(None).cast("string"))
    failed = {(r.check, r.table_name) for r in data_tests(bars, broken, symbols, ["synthetic"]).where("NOT passed").collect()}
    assert failed == {("recompute", "monthly"), ("unique", "risk"), ("not_null", "silver"), ("not_null", "long_term")}
    root = shared_dir(spark, "test-suite-edge")
    materialise_marts(spark, edge_bronze, root)
    report = data_tests(edge_bronze, stored_marts(spark, root), ["AAA", "BBB"], ["synthetic"])
    bad = {(r.check, r.table_name, r.column_name): r.failed_rows for r in report.where("NOT passed").collect()}
    assert bad[("not_null", "silver", "opening_price")] == 1          # NULL open survives Silver
    assert bad[("accepted_values", "silver", "symbol")] == 2          # CCC is not in the universe
    assert bad[("not_null", "risk", "monthly_volatility_pct")] == 2   # one-month / flat symbols
    with pytest.raises(GateError, match="data tests failed"):
        assert_data_tests(report)


def test_cli_build_and_test(spark):
    from barmarts.plans.cli import main
    root = shared_dir(spark, "test-cli")
    bars_from_tables(spark, SF_SMALL).write.parquet(f"{root}/bronze")
    assert main(["build", "--bronze", f"{root}/bronze", "--out", f"{root}/marts"], spark) == 0
    assert spark.read.parquet(f"{root}/marts/alerts").count() > 0
    brands = ",".join(f"Brand#{i}" for i in range(1, 26))
    assert main(["test", "--bronze", f"{root}/bronze", "--marts", f"{root}/marts", "--symbols", brands, "--providers", "synthetic"], spark) == 0
    assert main(["test", "--bronze", f"{root}/bronze", "--marts", f"{root}/marts", "--symbols", "Brand#1"], spark) == 1


def test_cli_backfill_and_incremental(spark):
    from barmarts.plans.cli import main
    root = shared_dir(spark, "test-cli-ingest")
    days = ["2024-01-02", "2024-01-03"]
    _land(spark, _vendor_rows("AAA", days) + _vendor_rows("BBB", days), f"{root}/hist")
    assert main(["backfill", "--landing", f"{root}/hist", "--table", f"{root}/bronze"], spark) == 0
    _land(spark, _vendor_rows("AAA", ["2024-01-04"], 9.0) + _vendor_rows("BBB", ["2024-01-04"], 8.0), f"{root}/inc")
    assert main(["incremental", "--landing", f"{root}/inc", "--table", f"{root}/bronze",
                 "--symbols", "AAA,BBB"], spark) == 0
    assert read_bronze(spark, f"{root}/bronze").count() == 6
    assert main(["incremental", "--landing", f"{root}/inc", "--table", f"{root}/bronze",
                 "--symbols", "AAA,BBB,CCC"], spark) == 1  # Q13 refuses: CCC missing


@pytest.mark.parametrize("key", ["dq_unique", "dq_accepted_values", "dq_composite_key", "dq_recompute"])
def test_single_checks_read_stored_tables(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    files = df.inputFiles()
    want = {"dq_unique": {"long_term", "risk", "market_summary"}, "dq_accepted_values": {"silver", "alerts"},
            "dq_composite_key": {"silver", "monthly"}, "dq_recompute": {"monthly"}}[key]
    assert all(any(f"/{name}/" in f for f in files) for name in want) and "Window" not in physical_tree(df)
