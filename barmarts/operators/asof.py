"""Backward as-of join (for each left row, the latest right row with the same key
and ``right.ts <= left.ts``).

Spark has no as-of operator, so the join is a keyed union: left and right rows are
tagged, unioned, and ``last(right, ignorenulls)`` runs over ``(key, bucket)`` ordered
by ``(ts, tag)`` with right rows before left rows at equal timestamps (on-or-before).

Splitting by ``bucket`` (a time truncation of ``ts``) bounds one window partition by
one key's rows in one bucket, so a key holding a third of all rows is spread over
many tasks. Rows early in a bucket take the carry-in: the latest right row of any
earlier bucket, computed from a per-(key, bucket) aggregate (one row per bucket) and a
small window over that bucket table. Nothing is dropped or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              right_cols: list[str], bucket: str | None = "day",
              prefix: str = "r_") -> DataFrame:
    """Left rows with ``prefix + right_ts`` and ``prefix + c`` for c in ``right_cols``
    (NULL when no right row precedes). Of several right rows at one timestamp the one with
    the greatest ``right_cols``, in their order, is taken."""
    rcols = [right_ts] + [c for c in right_cols if c != right_ts]

    lcols = left.columns
    L = left.select(F.col(key).alias("_k"), F.col(left_ts).alias("_ts"), F.lit(1).alias("_tag"),
                    F.struct(*lcols).alias("_l"), F.lit(None).cast(right.select(
                        F.struct(*rcols).alias("x")).schema["x"].dataType).alias("_r"))
    R = right.select(F.col(key).alias("_k"), F.col(right_ts).alias("_ts"), F.lit(0).alias("_tag"),
                     F.lit(None).cast(left.select(F.struct(*lcols).alias("x")).schema["x"].dataType).alias("_l"),
                     F.struct(*rcols).alias("_r")).where(F.col("_k").isNotNull() & F.col("_ts").isNotNull())
    both = L.unionByName(R)
    if bucket is None:
        part = ["_k"]
    else:
        both = both.withColumn("_b", F.date_trunc(bucket, F.col("_ts")))
        part = ["_k", "_b"]
    w = Window.partitionBy(*part).orderBy("_ts", "_tag", "_r").rowsBetween(Window.unboundedPreceding, 0)
    # _r is NULL on left rows, so the last non-NULL _r is the latest right row so far
    matched = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
    out = matched.where(F.col("_tag") == 1)
    if bucket is not None:
        # carry-in: latest right row of earlier buckets of the same key
        per_bucket = (R.withColumn("_b", F.date_trunc(bucket, F.col("_ts")))
                      .groupBy("_k", "_b").agg(F.max("_r").alias("_last")))
        keys_buckets = (L.select("_k", F.date_trunc(bucket, F.col("_ts")).alias("_b")).distinct()
                        .select("_k", "_b", F.lit(None).cast(per_bucket.schema["_last"].dataType).alias("_last")))
        grid = per_bucket.unionByName(keys_buckets)
        prev = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        carry = (grid.groupBy("_k", "_b").agg(F.first("_last", ignorenulls=True).alias("_last"))
                 .select("_k", "_b", F.last("_last", ignorenulls=True).over(prev).alias("_carry")))
        out = out.join(carry, ["_k", "_b"], "left").withColumn("_m", F.coalesce("_m", "_carry"))
    return out.select("_l.*", *[F.col(f"_m.{c}").alias(prefix + c) for c in rcols])
