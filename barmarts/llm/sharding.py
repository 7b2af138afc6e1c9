"""Operator 4: sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table (an offset
and a step taken from hashes of its name). The shards take turns; on its turn a shard
claims the first slot of its order that is still free, until the table is full. Shards get
equal shares (they differ by at most one slot), and when a shard leaves or joins nearly all
slots of the others stay where they were. A key's slot is its hash modulo the table size.

The table is a small frame of ``slots`` rows (65,537 by default, whatever the data), which
is broadcast, so placement is one hash and one lookup a row, without a shuffle.

Defined results: a null key goes to the slot of hash 0; repeated rows land on one shard; an
empty table gives an empty result; other columns pass through, columns named ``slot`` and
``shard`` are replaced. Texts are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
MAX_SLOTS = 1_048_583  # keeps the broadcast under 16 MB


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """table[slot] = index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be there and distinct")
    if not is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MAX_SLOTS}")
    offset = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, turn, claimed = np.full(slots, -1, dtype=np.int32), [0] * len(shards), 0
    while True:
        for k in range(len(shards)):
            while True:
                slot = (offset[k] + turn[k] * step[k]) % slots
                turn[k] += 1
                if table[slot] < 0:
                    break
            table[slot] = k
            claimed += 1
            if claimed == slots:
                return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    table = fill_table(shards, slots)
    return spark.createDataFrame([(i, int(k), shards[k]) for i, k in enumerate(table)], "slot long, shard int, shard_name string")


def assign(df: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (index into ``shards``)."""
    table = F.broadcast(table_frame(df.sparkSession, shards, slots).select("slot", "shard"))
    slot = F.pmod(F.when(F.col(key).isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(key)), F.lit(slots).cast("long"))
    return df.drop("shard").withColumn("slot", slot).join(table, "slot").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(df: DataFrame, path: str, shards: list[str], key: str = "doc_id", slots: int = SLOTS) -> None:
    """One folder per shard; rows of a shard are spread over tasks by AQE, so none has to hold a shard."""
    assign(df, shards, key, slots).hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
