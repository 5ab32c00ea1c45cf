"""Sharding by a permutation-filled lookup table (consistent hashing with constant-time lookup).

Each shard has its own preference order over the slots of a prime-sized table (start and
step from a hash of its name).  The shards take turns; at its turn a shard claims the first
slot of its order that is still free, until the table is full.  The shares differ by at
most one slot, and taking a shard away moves few keys besides its own.

A row's slot is a hash of its key modulo the table size; the table (``size`` rows, a
parameter, so its broadcast is bounded whatever the input) gives the shard.  No shuffle.

Defined results: a null key counts as the empty string; equal keys go to one shard, so
repeated rows stay together; an empty table gives an empty table; other columns pass
through, and an input column that has the name of an output column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The lookup table: for every slot the index of its shard.  ``size`` must be a prime of
    at least the number of shards (take 100 times as many or more for even shares).
    Expected work is size * ln(size) claims; it depends on parameters only."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _prime(size) or size < len(shards):
        raise ValueError("size must be a prime, not below the number of shards")
    at, step = [], []
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        at.append(int.from_bytes(d[:8], "big") % size)
        step.append(int.from_bytes(d[8:], "big") % (size - 1) + 1)
    out, left = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while out[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            out[at[i]] = i
            left -= 1
            if not left:
                return out


def slot(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of its MD5 modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size))


def lookup(spark: SparkSession, lookup_table: list[int]) -> DataFrame:
    """The filled table as rows ``(slot, shard_id)``, from one literal (no RDD)."""
    row = F.split(F.lit(",".join(map(str, lookup_table))), ",")
    return (spark.range(1).select(F.posexplode(row).alias("slot", "shard"))
            .select(F.col("slot").cast("long"), F.col("shard").cast("int").alias("shard_id")))


def shard(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard_id`` by a broadcast hash join with the lookup table."""
    placed = df.drop("slot", "shard_id").withColumn("slot", slot(F.col(key), size))
    return placed.join(F.broadcast(lookup(df.sparkSession, fill(shards, size))), "slot", "left")


def write_sharded(df: DataFrame, key: str, shards: list[str], path: str, size: int = TABLE_SIZE,
                  files_per_shard: int = 1) -> None:
    """One folder ``shard_id=<i>`` per shard; ``files_per_shard`` splits each by its slots, so
    no task holds a whole shard."""
    part = F.pmod(F.col("slot"), F.lit(files_per_shard))
    (shard(df, key, shards, size).repartition(len(shards) * files_per_shard, "shard_id", part)
     .drop("slot").write.partitionBy("shard_id").parquet(path))
