"""Twin forms: one-pass vs self-join marts, split vs plain silver, bucketed vs plain as-of,
distributed rank vs window rank."""
import datetime as dt
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from barmarts.operators import gold
from barmarts.operators.asof import asof_join
from barmarts.operators.ranking import global_rank
from barmarts.operators.silver import silver
from barmarts.sources.tables import bars_from_tables
from conftest import SF_SMALL


def _same(a, b):
    ca, cb = sorted(a.columns), sorted(b.columns)
    assert ca == cb
    ra = sorted(map(tuple, a.select(*ca).collect()), key=repr)
    rb = sorted(map(tuple, b.select(*cb).collect()), key=repr)
    assert ra == rb


def test_monthly_join_form_matches_one_pass(spark):
    s = silver(bars_from_tables(spark, SF_SMALL))
    _same(gold.monthly_performance(s), gold.monthly_performance_join_form(s))


def test_long_term_join_form_matches_one_pass(spark):
    s = silver(bars_from_tables(spark, SF_SMALL))
    _same(gold.long_term_performance(s), gold.long_term_performance_join_form(s))


def test_join_form_fans_out_on_duplicate_key(spark, edge_bronze):
    s = silver(edge_bronze)
    dup = s.unionByName(s.where((F.col("symbol") == "AAA") & (F.col("price_date") == dt.date(2024, 1, 2))))
    one_pass = gold.monthly_performance(dup)
    joined = gold.monthly_performance_join_form(dup)
    assert one_pass.count() == 5
    assert joined.count() == 6  # the repeated first-of-month row multiplies the join


def test_split_silver_matches_plain(spark):
    b = bars_from_tables(spark, SF_SMALL)
    plain = silver(b, split_by=None)
    for unit in ("week", "month", "year"):
        _same(plain, silver(b, split_by=unit))


def test_split_silver_short_chunks(spark):
    # months with 1-2 bars force the halo to reach back over several chunks
    rows = []
    d = dt.date(2020, 1, 15)
    for i in range(40):
        rows.append(("X", d, 10.0, 11.0, 9.0, 10.0, float(100 + i), 1, "s", "historical", "b", dt.datetime(2024, 1, 1)))
        d = d + dt.timedelta(days=17 if i % 3 else 40)
    from barmarts.schemas import BRONZE
    df = spark.createDataFrame(rows, BRONZE)
    _same(silver(df), silver(df, split_by="month"))


def _brute_asof(left: pd.DataFrame, right: pd.DataFrame):
    out = []
    for _, l in left.iterrows():
        cand = right[(right.k == l.k) & (right.ts <= l.ts)]
        if len(cand):
            r = cand.sort_values("ts").iloc[-1]
            out.append((l.id, r.ts, r.v))
        else:
            out.append((l.id, None, None))
    return sorted(out, key=repr)


def test_asof_bucketed_matches_brute_force(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    left = [(i, rnd.choice([1, 2, 3, None]), t0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6)))
            for i in range(300)]
    right = [(rnd.choice([1, 2, 3, 4]), t0 + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 6)), float(j))
             for j in range(120)]
    # key 1 holds most right rows on one day, key 3 has days without any right row
    right += [(1, t0 + dt.timedelta(days=2, minutes=j), 1000.0 + j) for j in range(200)]
    L = spark.createDataFrame(left, "id long, k long, ts timestamp")
    R = spark.createDataFrame(right, "k long, ts timestamp, v double")
    lp, rp = L.toPandas(), R.toPandas()
    expect = _brute_asof(lp, rp)
    for bucket in ["day", "hour", None]:
        got = asof_join(L, R, "k", "ts", "ts", ["v"], bucket=bucket)
        rows = sorted(((r.id, r.r_ts, r.r_v) for r in got.collect()), key=repr)
        assert len(rows) == 300
        assert [(a, None if b is None else pd.Timestamp(b), c) for a, b, c in rows] == \
               [(a, None if b is None else pd.Timestamp(b), c) for a, b, c in expect]


def test_global_rank_matches_window(spark):
    rnd = random.Random(3)
    rows = [(f"s{i:04d}", rnd.choice([None, rnd.uniform(-50, 50), 1.5])) for i in range(2000)]
    df = spark.createDataFrame(rows, "symbol string, r double")
    order = [F.col("r").desc_nulls_last(), F.col("symbol").asc()]
    got = global_rank(df, order, "rk", partitions=7)
    ref = df.withColumn("rk", F.row_number().over(Window.orderBy(*order)))
    _same(got, ref)
