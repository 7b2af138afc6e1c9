"""Q1-Q15 with passing and failing inputs; P1-P6 normalisation; upsert idempotence;
landing round trip; stream = batch."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barmarts.operators import quality
from barmarts.operators.normalise import (newest_bar_per_symbol, normalise_landing, normalise_name,
                                          history_since)
from barmarts.operators.silver import silver
from barmarts.operators.upsert import merge_sql, upsert, upsert_into_path
from barmarts.schemas import BRONZE, BRONZE_COLUMNS
from barmarts.session import shared_dir
from barmarts.sources.landing import consolidate, read_landing, universe_frame, write_landing
from barmarts.sources.tables import bars_from_tables
from conftest import SF_SMALL


def _bars(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def _row(sym, day, adj=10.0, close=10.0, volume=100):
    return (sym, dt.date.fromisoformat(day), 10.0, 11.0, 9.0, close, adj, volume, "synthetic",
            "historical", "b0", dt.datetime(2024, 1, 1))


def _sorted(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


# --- profiles and checks --------------------------------------------------------------

def test_duplicate_counts_key_three_times(spark):
    df = _bars(spark, [_row("A", "2024-01-02")] * 3 + [_row("A", "2024-01-03"), _row("B", "2024-01-02")])
    assert quality.duplicate_keys(df).count() == 1                       # A12: one group
    r = quality.duplicate_row_count(df).first()
    assert (r.duplicate_rows, r.duplicate_groups) == (2, 1)              # A13: two extra rows
    with pytest.raises(quality.GateError, match="no_duplicate_keys=2"):  # Q11 refuses
        quality.enforce_gates(df, required=None)
    prof = {r.symbol: r for r in quality.profile_by_symbol(df).collect()}
    assert (prof["A"].row_count, prof["A"].duplicate_rows) == (4, 2)


def test_not_null_and_accepted_values(spark, edge_bronze):
    rep = {(r.table_name, r.column_name): r.failed_rows
           for r in quality.not_null_report(silver(edge_bronze), "silver", ["opening_price", "symbol"]).collect()}
    assert rep == {("silver", "opening_price"): 1, ("silver", "symbol"): 0}
    df = _bars(spark, [_row("AAA", "2024-01-02"), _row("ZZZ", "2024-01-02")]).withColumn(
        "symbol", F.when(F.col("symbol") == "AAA", F.lit(None)).otherwise(F.col("symbol")))
    r = quality.accepted_values_report(df, "bronze", "symbol", ["AAA"]).first()
    assert r.failed_rows == 1  # ZZZ flagged, NULL not flagged


def test_unique_and_recompute(spark, edge_bronze):
    from barmarts.operators import gold
    m = gold.monthly_performance(silver(edge_bronze))
    assert quality.unique_report(m, "monthly", ["symbol", "month_start_date"]).first().failed_rows == 0
    assert quality.unique_report(m.unionByName(m.limit(1)), "monthly", ["symbol", "month_start_date"]
                                 ).first().failed_rows == 1
    assert quality.recompute_report(m).first().failed_rows == 0
    broken = m.withColumn("monthly_return_pct", F.col("monthly_return_pct") + 1)
    # the BBB February row has first price 0 and is skipped
    assert quality.recompute_report(broken).first().failed_rows == 4


def test_gates(spark):
    good = _bars(spark, [_row("A", "2024-01-02"), _row("B", "2024-01-02")])
    quality.enforce_gates(good, universe_frame(spark, ["A", "B"]))
    with pytest.raises(quality.GateError, match=r"missing symbols: \['C'\]"):          # Q13
        quality.enforce_gates(good, universe_frame(spark, ["A", "B", "C"]))
    nan = _bars(spark, [_row("A", "2024-01-02", adj=float("nan"))])
    with pytest.raises(quality.GateError, match="no_null_required=1"):                 # Q12 NaN
        quality.enforce_gates(nan)
    empty = good.where(F.lit(False))
    with pytest.raises(quality.GateError, match="not_empty=1"):                        # Q14
        quality.enforce_gates(empty, required=None)


def test_split_policies(spark):
    rows = [_row("A", "2024-01-02"), _row("A", "2024-01-03", adj=float("nan")),
            _row("B", "2024-01-02"), _row("C", "2024-01-02"), _row("C", "2024-01-02")]
    df = _bars(spark, rows)
    hist = {(r.symbol, r.price_date, r.adjusted_close == r.adjusted_close): (r.status, r.reject_reason)
            for r in quality.split_rejects(df, "historical").collect()}
    assert hist[("B", dt.date(2024, 1, 2), True)] == ("accepted", None)
    assert hist[("A", dt.date(2024, 1, 2), True)] == ("rejected", "symbol_failed")
    assert hist[("A", dt.date(2024, 1, 3), False)] == ("rejected", "null_required")
    assert hist[("C", dt.date(2024, 1, 2), True)] == ("rejected", "duplicate_key")
    inc = quality.split_rejects(df, "incremental")
    assert inc.where("status = 'accepted'").count() == 0
    assert inc.where("reject_reason = 'batch_failed'").count() == 2  # the clean rows A, B
    ok = quality.split_rejects(_bars(spark, [_row("B", "2024-01-02")]), "incremental")
    assert ok.first().status == "accepted"


# --- normalisation --------------------------------------------------------------------

def test_header_normalisation():
    assert normalise_name(" Adj Close ") == "adj_close"
    assert normalise_name("Vol.") == "vol"
    assert normalise_name("Close|SPY") == "close"


def test_normalise_landing_and_bad_volume(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", "1", "2", "0.5", "1.5", "1.4", "12"),
         ("Ticker", "SPY", "SPY", "SPY", "SPY", "SPY", "SPY")],
        ["Date", "Open", "High", "Low", "Close", " Adj Close ", "Volume"])
    out = normalise_landing(raw, "yahoo_finance", "incremental", "b1", "2024-01-03 00:00:00", symbol="SPY")
    assert out.columns == BRONZE_COLUMNS
    r = out.collect()
    assert len(r) == 1 and r[0].volume == 12 and r[0].adjusted_close == 1.4
    bad = spark.createDataFrame([("2024-01-02", "1", "2", "0.5", "1.5", "1.4", "12x")],
                                ["Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalise_landing(bad, "p", "historical", "b", "2024-01-03 00:00:00", symbol="S").collect()
    with pytest.raises(ValueError, match="Missing columns"):
        normalise_landing(bad.drop("Volume"), "p", "historical", "b", "2024-01-03 00:00:00", symbol="S")


def test_newest_and_history(spark):
    df = _bars(spark, [_row("A", "2024-01-02"), _row("A", "2024-01-05"), _row("B", "2023-12-29")])
    newest = {r.symbol: r.price_date for r in newest_bar_per_symbol(df).collect()}
    assert newest == {"A": dt.date(2024, 1, 5), "B": dt.date(2023, 12, 29)}
    assert history_since(df, "2024-01-01").count() == 2


# --- upsert, landing, stream ----------------------------------------------------------

def test_upsert_replaces_and_is_idempotent(spark):
    target = _bars(spark, [_row("A", "2024-01-02", adj=1.0), _row("A", "2024-01-03", adj=2.0)])
    batch = _bars(spark, [_row("A", "2024-01-03", adj=20.0), _row("A", "2024-01-04", adj=30.0)])
    once = upsert(target, batch)
    twice = upsert(once, batch)
    assert _sorted(once) == _sorted(twice)
    assert {r.price_date.day: r.adjusted_close for r in once.collect()} == {2: 1.0, 3: 20.0, 4: 30.0}
    assert "WHEN MATCHED THEN UPDATE SET *" in merge_sql("t", "s")


def test_upsert_into_path_twice(spark):
    path = shared_dir(spark, "test-upsert") + "/bronze"
    bars = bars_from_tables(spark, SF_SMALL)
    target = bars.where(F.col("price_date") < "2001-06-01")
    batch = bars.where(F.col("price_date") >= "2001-05-01").withColumn("adjusted_close", F.col("adjusted_close") * 2)
    upsert_into_path(spark, path, target)
    first = _sorted(upsert_into_path(spark, path, batch))
    second = _sorted(upsert_into_path(spark, path, batch))
    assert first == second
    assert first == _sorted(upsert(target, batch))


def test_landing_roundtrip_and_consolidate(spark):
    root = shared_dir(spark, "test-landing")
    bars = bars_from_tables(spark, SF_SMALL)
    write_landing(bars, f"{root}/land")
    back = read_landing(spark, f"{root}/land")
    assert _sorted(back) == _sorted(bars)
    # re-landing one symbol replaces only its partitions
    write_landing(bars.where(F.col("symbol") == "Brand#1"), f"{root}/land")
    assert read_landing(spark, f"{root}/land").count() == bars.count()
    assert _sorted(consolidate(spark, f"{root}/land", f"{root}/one")) == _sorted(bars)
    dup = bars.unionByName(bars.limit(1))
    write_landing(dup, f"{root}/dup")
    with pytest.raises(quality.GateError):
        consolidate(spark, f"{root}/dup", f"{root}/dup-out")


def test_stream_equals_batch(spark):
    from barmarts.streaming.ingest import run_available_now
    root = shared_dir(spark, "test-stream")
    bars = bars_from_tables(spark, SF_SMALL)
    target = bars.where(F.col("price_date") < "2001-06-01")
    batch = bars.where(F.col("price_date") >= "2001-05-01").withColumn("load_type", F.lit("incremental"))
    upsert_into_path(spark, f"{root}/bronze", target)
    drops = [batch.where(F.col("price_date") < "2001-07-01"), batch.where(F.col("price_date") >= "2001-07-01"),
             batch.where(F.col("price_date") < "2001-07-01")]  # the first drop lands twice
    for d in drops:
        d.write.mode("append").option("header", True).csv(f"{root}/landing")
    out = run_available_now(spark, f"{root}/landing", f"{root}/bronze", checkpoint=f"{root}/ckpt",
                            max_files_per_trigger=4)
    assert _sorted(out) == _sorted(upsert(target, batch))


def test_stream_refuses_conflicting_versions(spark):
    from barmarts.streaming.ingest import run_available_now
    root = shared_dir(spark, "test-stream-conflict")
    a = _bars(spark, [_row("A", "2024-01-02", adj=1.0)])
    b = _bars(spark, [_row("A", "2024-01-02", adj=2.0)])
    a.unionByName(b).coalesce(1).write.option("header", True).csv(f"{root}/landing")
    with pytest.raises(Exception, match="no_duplicate_keys=1"):
        run_available_now(spark, f"{root}/landing", f"{root}/bronze", checkpoint=f"{root}/ckpt")


def test_stream_refuses_null_required(spark):
    from barmarts.streaming.ingest import run_available_now
    root = shared_dir(spark, "test-stream-null")
    _bars(spark, [_row("A", "2024-01-02", adj=float("nan"))]).write.option("header", True).csv(f"{root}/landing")
    with pytest.raises(Exception, match="no_null_required=1"):
        run_available_now(spark, f"{root}/landing", f"{root}/bronze", checkpoint=f"{root}/ckpt")


def test_register_view_and_approx_profile(spark):
    from barmarts.sources.landing import register_view
    bars = bars_from_tables(spark, SF_SMALL)
    register_view(bars, "bars_view")
    exact = quality.table_profile(spark.table("bars_view")).first()
    approx = quality.table_profile(bars, approx=True).first()
    assert exact.total_rows == spark.sql("SELECT COUNT(*) FROM bars_view").first()[0]
    assert (approx.total_rows, approx.earliest_date, approx.latest_date) == \
        (exact.total_rows, exact.earliest_date, exact.latest_date)
    assert abs(approx.total_symbols - exact.total_symbols) <= 2


def test_upsert_replay_and_stops_lose_nothing(spark, monkeypatch):
    from barmarts.operators import upsert as U
    path = shared_dir(spark, "test-replay") + "/bronze"
    days = {d: _bars(spark, [_row("A", f"2024-01-0{d}", adj=float(d))]) for d in range(2, 7)}
    state = lambda: {r.price_date.day: r.adjusted_close for r in U.read_bronze(spark, path).collect()}
    upsert_into_path(spark, path, days[2])
    upsert_into_path(spark, path, days[3], token=("s", 0))
    upsert_into_path(spark, path, days[4])
    upsert_into_path(spark, path, _bars(spark, [_row("A", "2024-01-03", adj=30.0)]))
    upsert_into_path(spark, path, days[3], token=("s", 0))  # replay after other upserts
    assert state() == {2: 2.0, 3: 30.0, 4: 4.0}
    upsert_into_path(spark, path, days[5], token=("afresh", 0))  # a new stream starts at 0 again
    assert state()[5] == 5.0
    # a stop between the written months and the publication, with and without token
    for token in (None, ("s", 1)):
        with monkeypatch.context() as m:
            def stop(*_):
                raise RuntimeError("stopped")
            m.setattr(U, "_replace_pointer", stop)
            with pytest.raises(RuntimeError):
                upsert_into_path(spark, path, days[6], token=token)
        assert state() == {2: 2.0, 3: 30.0, 4: 4.0, 5: 5.0}
    upsert_into_path(spark, path, days[6], token=("s", 1))
    assert state() == {2: 2.0, 3: 30.0, 4: 4.0, 5: 5.0, 6: 6.0}
    # the folder that the last update replaced is still there for readers, older ones are gone
    retired = U.read_pointer(spark, path)["retired"]
    assert len(retired) == 1 and spark.read.parquet(f"{path}/{retired[0]}").count() == 4
    upsert_into_path(spark, path, days[2])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{path}/{retired[0]}").count()


def test_second_writer_is_refused(spark, monkeypatch):
    from barmarts.operators import upsert as U
    path = shared_dir(spark, "test-race") + "/bronze"
    upsert_into_path(spark, path, _bars(spark, [_row("A", "2024-01-02")]))
    real, done = U.upsert, []

    def late(*args):
        if not done:
            done.append(1)
            upsert_into_path(spark, path, _bars(spark, [_row("B", "2024-01-02")]))
        return real(*args)

    monkeypatch.setattr(U, "upsert", late)
    with pytest.raises(RuntimeError, match="one writer"):
        upsert_into_path(spark, path, _bars(spark, [_row("C", "2024-01-02")]))
    assert {r.symbol for r in U.read_bronze(spark, path).collect()} == {"A", "B"}  # the first one's rows are not lost


def test_landing_by_header(spark, tmp_path):
    root = tmp_path / "tree"
    names = ["symbol", "price_date", "open", "high", "low", "close", "adjusted_close", "volume", "source_provider",
             "load_type", "batch_id", "ingested_at_utc"]
    values = {"price_date": "2024-01-02", "open": "1", "high": "2.0", "low": "0.5", "close": "1.5", "adjusted_close": "1.5",
              "volume": "9007199254740993", "source_provider": "p", "load_type": "historical", "batch_id": "b",
              "ingested_at_utc": "2024-01-01 00:00:00"}
    for symbol in ("0700", "1E5", "A+B"):
        leaf = root / f"symbol={symbol}" / "load_type=historical"
        leaf.mkdir(parents=True)
        (leaf / "prices.csv").write_text(",".join(names) + "\n" + ",".join([symbol, *[values[n] for n in names[1:]]]) + "\n")
    rows = {r.symbol: r for r in read_landing(spark, str(root)).collect()}
    assert set(rows) == {"0700", "1E5", "A+B"} and rows["0700"].high == 2.0 and rows["1E5"].volume == 9007199254740993
    # keys in the path only
    path_only = tmp_path / "path_only"
    for symbol in ("0700", "A+B"):
        leaf = path_only / f"symbol={symbol}" / "load_type=historical"
        leaf.mkdir(parents=True)
        rest = [n for n in names if n not in ("symbol", "load_type")]
        (leaf / "prices.csv").write_text(",".join(rest) + "\n" + ",".join(values[n] for n in rest) + "\n")
    got = read_landing(spark, str(path_only)).collect()
    assert {(r.symbol, r.load_type, r.high) for r in got} == {("0700", "historical", 2.0), ("A+B", "historical", 2.0)}
    # another column order in one file is refused, not read by position
    leaf = root / "symbol=Z" / "load_type=historical"
    leaf.mkdir(parents=True)
    (leaf / "prices.csv").write_text(",".join(names[::-1]) + "\n" + ",".join(["Z" if n == "symbol" else values[n] for n in names[::-1]]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, str(root)).collect()
    (leaf / "prices.csv").write_text(",".join(names) + "\n" + ",".join("12x" if n == "volume" else "Z" if n == "symbol" else values[n] for n in names) + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_landing(spark, str(root)).collect()


def test_typed_input_and_null_keys(spark):
    bars = bars_from_tables(spark, SF_SMALL)
    assert _sorted(normalise_landing(bars)) == _sorted(bars)
    keys = spark.createDataFrame([("A", None), ("A", None), ("B", 1)], "a string, b int")
    assert quality.unique_report(keys, "t", ["a", "b"], "composite_key").first().failed_rows == 1
    assert quality.unique_report(keys, "t", ["a", "b"]).first().failed_rows == 0
    two = _bars(spark, [_row("A", "2024-01-02", adj=1.0), _row("A", "2024-01-02", adj=2.0)])
    assert newest_bar_per_symbol(two).count() == 2  # a conflict stays visible to the gate


def test_partitioned_replace_drops_old_keys(spark):
    from barmarts.sources.landing import materialise
    path = shared_dir(spark, "test-replace")
    materialise(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, ["k"])
    assert [r.k for r in materialise(spark.createDataFrame([("b", 2)], "k string, v int"), path, ["k"]).collect()] == ["b"]


def test_missing_shared_folder_raises_on_a_cluster():
    from types import SimpleNamespace

    from barmarts.session import _checkpoint_root
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                              sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _checkpoint_root(cluster)


def test_global_rank_on_many_rows(spark):
    from barmarts.operators.ranking import global_rank
    rows = spark.range(400_000).selectExpr(
        "id", "CASE WHEN id % 1000 = 7 THEN NULL ELSE CAST(xxhash64(id) % 5000 AS double) END AS v", "repeat('x', 40) AS payload")
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    out = global_rank(rows, order, partitions=16)
    want = rows.withColumn("want", F.row_number().over(Window.orderBy(*order)))
    assert out.join(want.select("id", "want"), "id").where("rank <> want").count() == 0 and out.count() == 400_000


def test_read_landing_empty_tree_raises(spark):
    import os
    root = shared_dir(spark, "test-empty-landing")
    os.makedirs(root.replace("file:", ""), exist_ok=True)
    with pytest.raises(FileNotFoundError):
        read_landing(spark, root)


def test_incremental_landing_layout(spark):
    import os
    root = shared_dir(spark, "test-landing-inc")
    bars = newest_bar_per_symbol(bars_from_tables(spark, SF_SMALL)).withColumn("load_type", F.lit("incremental"))
    write_landing(bars, f"{root}/land", "incremental")
    leaf = [d for d, _, _ in os.walk(root.replace("file:", "")) if "price_date=" in d]
    assert leaf and all("symbol=" in d and "load_type=incremental" in d for d in leaf)
    assert _sorted(read_landing(spark, f"{root}/land")) == _sorted(bars)


def test_upsert_replaces_lineage_of_matched_rows(spark):
    target = _bars(spark, [_row("A", "2024-01-02"), _row("A", "2024-01-03")])
    batch = _bars(spark, [_row("A", "2024-01-03")]).withColumns(
        {"load_type": F.lit("incremental"), "batch_id": F.lit("b9"),
         "ingested_at_utc": F.lit(dt.datetime(2024, 2, 1))})
    got = {r.price_date.day: (r.load_type, r.batch_id, r.ingested_at_utc) for r in upsert(target, batch).collect()}
    assert got[3] == ("incremental", "b9", dt.datetime(2024, 2, 1))
    assert got[2] == ("historical", "b0", dt.datetime(2024, 1, 1))


def test_dimension_csv_and_empty_profiles(spark):
    from barmarts.sources.landing import read_dimension
    root = shared_dir(spark, "test-dim-csv")
    spark.createDataFrame([("AAA", "A fund", "Equity", "US", "Large cap")],
                          "symbol string, name string, asset_class string, region string, category string") \
        .write.option("header", True).csv(f"{root}/dim")
    d = read_dimension(spark, f"{root}/dim", fmt="csv").first()
    assert (d.symbol, d.region) == ("AAA", "US")
    empty = _bars(spark, [_row("A", "2024-01-02")]).where(F.lit(False))
    p = quality.table_profile(empty).first()
    assert (p.total_rows, p.total_symbols, p.earliest_date) == (0, 0, None)
    assert quality.duplicate_row_count(empty).first().duplicate_rows == 0
    assert {r.gate: r.passed for r in quality.gate_report(empty).collect()} == \
        {"no_duplicate_keys": True, "no_null_required": True, "not_empty": False}
