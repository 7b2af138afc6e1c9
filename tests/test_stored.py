"""Stored and streamed forms: observed writes, clustered and published storage, state, parts."""
import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from barmarts.operators import incremental, quality
from barmarts.operators.gold import monthly_performance, risk_summary
from barmarts.operators.normalise import normalise_landing
from barmarts.operators.observed import batch_metrics, judge, store_observed
from barmarts.operators.quality import GateError
from barmarts.operators.silver import silver
from barmarts.plans.pipeline import historical_load, materialise_marts, newest_batch
from barmarts.schemas import BRONZE
from barmarts.session import shared_dir
from barmarts.sources import published
from barmarts.sources.clustered import MAX_LISTED, read_clustered, write_clustered, zones
from barmarts.sources.landing import read_landing, read_vendor_csv
from barmarts.sources.tables import bronze_table, input_fingerprint, read_table
from barmarts.streaming.state import run_closed_days, run_newest_bars
from conftest import SF_SMALL
from test_pipeline import _vendor_rows
from test_plans import physical_tree


def _bar(symbol, day, adj=10.0):
    return (symbol, dt.date.fromisoformat(day), 10.0, 11.0, 9.0, 10.0, adj, 100, "p", "historical", "b", dt.datetime(2024, 1, 1))


def _land(spark, rows, path):
    spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").option("header", True).csv(path)


# --- measured while written --------------------------------------------------------------

def test_write_is_measured_and_judged(spark):
    nullable = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE.fields)
    rows = [_bar("A", "2024-01-02"), _bar("A", "2024-01-05"), (*_bar("B", "2024-01-03")[:2], None, *_bar("B", "2024-01-03")[3:])]
    batch = spark.createDataFrame(rows, nullable)
    stored, seen = store_observed(batch, shared_dir(spark, "test-observed"), **batch_metrics(batch))
    assert stored.count() == 3 and (seen["total_rows"], seen["null_required"], seen["about_symbols"]) == (3, 1, 2)
    assert (seen["earliest_date"], seen["latest_date"]) == (dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    with pytest.raises(GateError, match="no_null_required=1"):
        judge(seen)
    judge(seen, nulls=False)
    none = batch.where("false")
    with pytest.raises(GateError, match="not_empty"):
        judge(store_observed(none, shared_dir(spark, "test-observed"), **batch_metrics(none))[1])


def test_daily_load_scans_the_landing_once(spark):
    root = shared_dir(spark, "test-one-scan")
    spark.createDataFrame(_vendor_rows("AAA", ["2024-01-02", "2024-01-03"]),
                          "Symbol string, Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume string") \
        .write.option("header", True).csv(root)
    rows = normalise_landing(read_vendor_csv(spark, root), "p", "incremental", "b", "2024-01-05 00:00:00", tag_faults=True)
    batch, day, newest = newest_batch(rows)
    plan = physical_tree(batch.observe("m", *[c.alias(n) for n, c in newest.items()]))
    assert plan.count("Scan csv") == 1 and plan.count("CollectMetrics") == 2


def test_malformed_and_header_lines_are_reported(spark, tmp_path):
    good = "Symbol,Date,Open,High,Low,Close,Adj Close,Volume\nAAA,2024-01-02,1,2,0.5,1,1,5\nBBB,2024-01-02,1,2,0.5,1,1,5\nBBB,Date,x,x,x,x,x,x\n"
    (tmp_path / "one.csv").write_text(good)
    (tmp_path / "two.csv").write_text("Symbol,Date,Open,High,Low,Close,Adj Close,Volume\nCCC,2024-01-02,1,2,0.5,1,1\nCCC,2024-01-03,1,2,0.5,1,1,5,6,7\nCCC,2024-01-04,1,2,0.5,1,1,5\n")
    table = shared_dir(spark, "test-malformed") + "/bronze"
    report = historical_load(spark, read_vendor_csv(spark, str(tmp_path)), table, "p", "b-malformed", "2024-01-05 00:00:00")
    rows = {(r.symbol, r.reject_reason, r._line and r._line.rsplit("/", 1)[-1]) for r in report.collect()}
    assert rows == {("BBB", "header_row", None), ("CCC", "malformed_line", "two.csv: CCC,2024-01-02,1,2,0.5,1,1"),
                    ("CCC", "malformed_line", "two.csv: CCC,2024-01-03,1,2,0.5,1,1,5,6,7"), ("CCC", "symbol_failed", None)}
    from barmarts.operators.upsert import read_bronze
    assert {r.symbol for r in read_bronze(spark, table).collect()} == {"AAA", "BBB"}
    with pytest.raises(Exception, match="malformed line"):  # without tags the read stops
        normalise_landing(read_vendor_csv(spark, str(tmp_path)), "p", "historical", "b", "2024-01-05 00:00:00").collect()


def test_key_in_neither_file_nor_path_raises(spark, tmp_path):
    leaf = tmp_path / "symbol=A"
    leaf.mkdir()
    names = [c for c in BRONZE.names if c not in ("symbol", "load_type")]
    (leaf / "prices.csv").write_text(",".join(names) + "\n2024-01-02,1,2,0.5,1,1,5,p,b,2024-01-01 00:00:00\n")
    with pytest.raises(Exception, match="load_type=<value>"):
        read_landing(spark, str(tmp_path)).collect()
    (leaf / "prices.csv").write_text("price_date,open\n2024-01-02,1\n")
    with pytest.raises(ValueError, match="lack columns.*high"):
        read_landing(spark, str(tmp_path))


# --- storage -----------------------------------------------------------------------------

def test_clustered_lookup_opens_few_files(spark, monkeypatch):
    path = shared_dir(spark, "test-clustered") + "/bars"
    bars = bronze_table(spark, SF_SMALL)
    stored = write_clustered(bars, path, ["symbol", "price_date"], files=24)
    assert stored.count() == bars.count() == zones(spark, path).agg(F.sum("rows")).first()[0]
    bounds = {"symbol": ("Brand#3", "Brand#3"), "price_date": (dt.date(1999, 1, 1), None)}
    found = read_clustered(spark, path, **bounds)
    want = bars.where("symbol = 'Brand#3' AND price_date >= '1999-01-01'")
    assert found.count() == want.count() > 0 and found.exceptAll(want).count() == 0

    def size(files):
        return sum(os.path.getsize(f.replace("file://", "").replace("file:", "")) for f in files)
    assert size(found.inputFiles()) <= 0.2 * size(stored.inputFiles())
    assert read_clustered(spark, path, symbol=("Z", None)).count() == 0
    import barmarts.sources.clustered as C
    assert MAX_LISTED > 2
    monkeypatch.setattr(C, "MAX_LISTED", 1)  # too many files to name: the whole table, same rows
    assert read_clustered(spark, path, symbol=("Brand#1", "Brand#9")).count() == bars.where("symbol BETWEEN 'Brand#1' AND 'Brand#9'").count()


def test_stopped_rebuild_leaves_the_old_tables(spark, monkeypatch):
    root, layer = shared_dir(spark, "test-published"), "l" + os.urandom(4).hex()
    store = published.publisher(spark, dict.fromkeys(("silver", "monthly", "long_term", "market_summary", "risk", "alerts"), layer), root)
    bars = bronze_table(spark, SF_SMALL)
    early = bars.where("price_date < '1999-01-01'")
    materialise_marts(spark, early, root, store=store)
    before, reader = spark.table(f"{layer}.monthly").count(), spark.table(f"{layer}.monthly")
    with monkeypatch.context() as m:
        def stop(*_):
            raise RuntimeError("stopped")
        m.setattr(published, "_show", stop)
        with pytest.raises(RuntimeError):
            materialise_marts(spark, bars, root, store=store)
    assert spark.table(f"{layer}.monthly").count() == before
    materialise_marts(spark, bars, root, store=store)
    assert spark.table(f"{layer}.monthly").count() > before
    assert reader.count() == before  # a reader that began before still reads its own state
    assert len(os.listdir(f"{root}/{layer}.monthly".replace("file:", ""))) <= 2


def test_fingerprint_sees_a_rewrite_deep_in_the_tree(spark, tmp_path):
    leaf = tmp_path / "a" / "b"
    leaf.mkdir(parents=True)
    (leaf / "x").write_text("one")
    first = input_fingerprint(spark, [str(tmp_path)])
    assert first == input_fingerprint(spark, [str(tmp_path)])
    os.utime(tmp_path, (1, 1))
    top = os.stat(tmp_path).st_mtime
    (leaf / "x").write_text("two")
    os.utime(leaf / "x", (2e9, 2e9))
    assert os.stat(tmp_path).st_mtime == top and input_fingerprint(spark, [str(tmp_path)]) != first


# --- state -------------------------------------------------------------------------------

def test_streams_keep_state_over_restarts(spark):
    root = shared_dir(spark, "test-state")
    paths = (f"{root}/landing", f"{root}/newest", f"{root}/newest-checkpoint")
    days = (f"{root}/landing", f"{root}/days", f"{root}/days-checkpoint", "3 days", 3)
    _land(spark, [_bar("A", "2024-01-02"), _bar("B", "2024-01-02"), _bar("A", "2024-01-03", 11.0)], f"{root}/landing")
    assert {(r.symbol, r.price_date.day) for r in run_newest_bars(spark, *paths).collect()} == {("A", 3), ("B", 2)}
    assert run_closed_days(spark, *days).count() == 0
    # late (C on the 2nd), repeated (A on the 3rd) and new rows
    _land(spark, [_bar("C", "2024-01-02"), _bar("A", "2024-01-03", 11.0), _bar("A", "2024-01-06", 12.0)], f"{root}/landing")
    got = {r.symbol: (r.price_date.day, r.adjusted_close) for r in run_newest_bars(spark, *paths).collect()}
    assert got == {"A": (6, 12.0), "B": (2, 10.0), "C": (2, 10.0)}
    assert [tuple(r)[1:] for r in run_closed_days(spark, *days).collect()] == [(3, 0)]  # the 2nd, complete
    # nothing new: nothing changes
    assert run_closed_days(spark, *days).count() == 1
    # a row of a closed day comes too late to count
    _land(spark, [_bar("D", "2024-01-02"), _bar("B", "2024-01-20")], f"{root}/landing")
    closed = {r.price_date.day: (r.n_symbols, r.n_missing) for r in run_closed_days(spark, *days).collect()}
    assert closed == {2: (3, 0), 3: (1, 2), 6: (1, 2)}
    assert {r.symbol: r.price_date.day for r in run_newest_bars(spark, *paths).collect()} == {"A": 6, "B": 20, "C": 2, "D": 2}


# --- parts -------------------------------------------------------------------------------

def test_merged_parts_equal_the_summary(spark, edge_bronze):
    random.seed(4)
    many = spark.createDataFrame(
        [(s, dt.date(1990 + y, m, 1), None if random.random() < 0.1 else random.uniform(-9, 9) + 1e6 * (s == "BIG"))
         for s in ("X", "Y", "BIG") for y in range(9) for m in range(1, 13)] + [("ONE", dt.date(2000, 1, 1), 3.0), ("NONE", dt.date(2000, 1, 1), None)],
        "symbol string, month_start_date date, monthly_return_pct double")
    for monthly in (monthly_performance(silver(edge_bronze)), many):
        got = {r.symbol: r for r in incremental.risk_from_parts(incremental.risk_parts(monthly)).collect()}
        want = {r.symbol: r for r in risk_summary(monthly).collect()}
        assert set(got) == set(want)
        for s, r in want.items():
            assert {k: v and float(v) for k, v in got[s].asDict().items() if k != "symbol"} == pytest.approx(
                {k: v and float(v) for k, v in r.asDict().items() if k != "symbol"}), s
    assert incremental.risk_from_parts(incremental.risk_parts(many)).where("symbol = 'ONE'").first().monthly_volatility_pct is None


def test_sketches_merge(spark):
    bars = spark.range(60_000).selectExpr("concat('S', id % 20000) AS symbol", "date_add(date'2020-01-01', int(id % 700)) AS price_date")
    stored = incremental.month_sketches(bars)
    p = incremental.profile_from_sketches(stored).first()
    assert p.total_rows == 60_000 and abs(p.about_symbols - 20_000) <= 3 * incremental.STANDARD_ERROR * 20_000
    assert incremental.profile_from_sketches(stored.where("false")).first().total_rows == 0


# --- change propagation, bucketed target -------------------------------------------------

def test_refresh_equals_a_full_rebuild(spark):
    from barmarts.operators import refresh
    from barmarts.operators.upsert import upsert
    random.seed(8)
    def bars(n, symbols="AB"):
        days = {(random.choice(symbols), dt.date(2024, 1, 1) + dt.timedelta(days=random.randrange(200))) for _ in range(n)}
        return spark.createDataFrame([(*_bar(s, d.isoformat(), random.uniform(1, 9))[:3], random.choice([11.0, 11.0, 8.0]), *_bar(s, d.isoformat(), random.uniform(1, 9))[4:])
                                      for s, d in sorted(days)], BRONZE)
    table = bars(150)
    old, chunks = silver(table), refresh.month_chunks(table)
    for batch in (bars(1), bars(12, "BC"), bars(60, "ABC"), bars(5, "D")):
        after = upsert(table, batch)
        touched = refresh.touched_chunks(batch)
        now = refresh.refreshed_chunks(chunks, touched, after)
        changed = refresh.changed_chunks(chunks, now, touched)
        got, want = refresh.refresh_silver(old, changed, after, now).collect(), silver(after).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert sorted(map(repr, now.collect())) == sorted(map(repr, refresh.month_chunks(after).collect()))
    # an update that keeps a chunk's dates and last closes changes that chunk alone
    first = old.where("symbol = 'A' AND trading_day_number = 1").first()
    again = table.where((F.col("symbol") == "A") & (F.col("price_date") == F.lit(first.price_date)))
    now = refresh.refreshed_chunks(chunks, refresh.touched_chunks(again), table)
    assert refresh.changed_chunks(chunks, now, refresh.touched_chunks(again)).count() == 1


def test_refresh_reads_the_folders_of_changed_months(spark):
    from barmarts.operators.upsert import read_bronze, upsert_into_path
    path = shared_dir(spark, "test-months") + "/bronze"
    upsert_into_path(spark, path, bronze_table(spark, SF_SMALL))
    some = read_bronze(spark, path, ["1999-02", "1999-03"])
    assert {f.rsplit("price_month=", 1)[1][:7] for f in some.inputFiles()} == {"1999-02", "1999-03"}


def test_bucketed_upsert_shuffles_the_batch_only(spark):
    from barmarts.plans.stored_queries import upsert_bucketed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical_tree(upsert_bucketed(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "LeftAnti" in plan


# --- duplicates in two passes ------------------------------------------------------------

@pytest.mark.parametrize("repeated", [0, 7, 400])
def test_suspect_rows_give_the_same_duplicates(spark, repeated):
    rng = random.Random(repeated)
    rows = [(f"s{k}", k % 9) for k in range(400)] + [(f"s{rng.randrange(400)}", rng.randrange(9)) for _ in range(repeated)]
    rows += [(None, 1), (None, 1), ("s1", None), (None, None)] + [("hot", 1)] * 200
    df = spark.createDataFrame(rows, "symbol string, day int").repartition(4).cache()
    keys = ["symbol", "day"]
    found = quality.suspect_rows(df, keys, f"{shared_dir(spark, 'suspects-test')}/hashes")
    want = {(r.symbol, r.day): r.row_count for r in quality.duplicate_keys(df, keys).collect()}
    assert {(r.symbol, r.day): r.row_count for r in quality.duplicate_keys(found, keys).collect()} == want
    assert want["hot", 1] == 200 and want[None, 1] == 2
    assert quality.duplicate_row_count(found, keys).first() == quality.duplicate_row_count(df, keys).first()
    for check in ("unique", "composite_key"):
        assert quality.unique_report(found, "t", keys, check).first() == quality.unique_report(df, "t", keys, check).first()
    # unique keys end at the first pass
    assert found.count() == sum(want.values())
    df.unpersist()


def test_second_pass_shuffles_no_unique_key(spark):
    df = read_table(spark, SF_SMALL, "lineitem")
    found = quality.suspect_rows(df, ["l_orderkey", "l_linenumber"], f"{shared_dir(spark, 'suspects-test')}/hashes")
    tree = physical_tree(quality.duplicate_keys(found, ["l_orderkey", "l_linenumber"]))
    # the rows meet the few hashes before their only exchange
    assert "BroadcastHashJoin LeftSemi" in tree and len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) == 1, tree
    empty = quality.suspect_rows(df.limit(0), ["l_orderkey"], f"{shared_dir(spark, 'suspects-test')}/hashes")
    assert quality.duplicate_row_count(empty, ["l_orderkey"]).first().duplicate_rows == 0
