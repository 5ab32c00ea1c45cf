"""Shard planning: seeded shuffles, even / appended / fixed-size shards, order inside a
shard, renaming of repeated files, latest row per id, shard statistics
(WIN1-WIN8, AGG10, AGG11, LIM1, LIM2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .index import indexed, with_index
from .manifest import path_ext, squash


def shuffle_key(seed: int, key: str = "utt_id") -> list[Column]:
    """WIN7: reproducible shuffle order: md5(seed || key), then key for ties.  Unlike
    ``rand()`` it does not change when a partition is recomputed."""
    return [F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)]


def file_shuffle_key(seed: int, file: str = "audio_filepath", idx: str = "input_idx") -> list[Column]:
    """WIN8: shuffle whole files; rows of one file stay together in input order."""
    return [F.md5(F.concat(F.lit(str(seed)), F.col(file))), F.col(file), F.col(idx)]


def shard_even(df: DataFrame, num_shards: int, order) -> tuple[DataFrame, DataFrame]:
    """WIN1: ``k = n // num_shards`` rows per shard in ``order``; the last
    ``n - k*num_shards`` rows are dropped (returned as the second frame)."""
    if num_shards < 1:
        raise ValueError("num_shards must be >= 1")           # D-3
    ix, n = indexed(df, order)
    if 0 < n < num_shards:                                    # D-2
        raise ValueError(f"{n} rows cannot fill {num_shards} shards")
    k = n // num_shards if n else 1
    kept = (ix.filter(F.col("idx") < k * num_shards)
            .withColumn("shard_id", (F.col("idx") / F.lit(k)).cast("int")))
    return kept, ix.filter(F.col("idx") >= k * num_shards)


def shard_append(new: DataFrame, per_shard: int, first_shard: int, order):
    """WIN2: append rows to an existing set: shard size from its metadata, ids continue
    after the existing shards, the remainder is dropped (all kept when it is 0, D-1)."""
    ix, m = indexed(new, order)
    full = (m // per_shard) * per_shard
    kept = ix.filter(F.col("idx") < full).withColumn(
        "shard_id", (F.lit(first_shard) + (F.col("idx") / F.lit(per_shard)).cast("int")).cast("int"))
    return kept, ix.filter(F.col("idx") >= full)


def shard_fixed(df: DataFrame, size: int, order) -> DataFrame:
    """WIN3: fixed-size shards ``idx // size`` (the subset exporter, default 1000)."""
    ix = with_index(df, order)
    return ix.withColumn("shard_id", (F.col("idx") / F.lit(size)).cast("int"))


def order_in_shard(sharded: DataFrame, sort_by_duration: bool = True) -> DataFrame:
    """WIN4: position inside each shard; by duration (ties in shard order) when
    ``sort_in_shards`` is on, else the shard order itself.  Only shard, duration and index are
    sorted; a null shard is a shard like others."""
    order = ["shard_id", "duration", "idx"] if sort_by_duration else ["shard_id", "idx"]
    return with_index(sharded, order, col="_g", group=1).drop("_g")


def number_repeats(df: DataFrame, file: str = "audio_filepath") -> DataFrame:
    """WIN5 + PRJ8: member name inside a shard.  The first row of a squashed name keeps
    it, the n-th repeat (shard order ``pos``) becomes ``base-sub{n}.ext``.  Rows without a
    file are numbered among themselves and keep a null name."""
    sq = df.withColumn("member", squash(F.col(file)))
    rep = with_index(sq, ["shard_id", "member", "pos"], col="_g", group=2, pos="repeat").drop("_g")
    ext = path_ext(F.col("member"))
    base = F.substring(F.col("member"), F.lit(1), F.length("member") - F.length(ext))
    renamed = F.concat(base, F.lit("-sub"), F.col("repeat").cast("string"), ext)
    return rep.withColumn("member", F.when(F.col("repeat") == 0, F.col("member")).otherwise(renamed))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """WIN6: last row per key by ``order``; ``max_by`` is a partial aggregate, so a hot
    key is combined map-side instead of gathered into one window task."""
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def shard_stats(sharded: DataFrame, file: str = "audio_filepath") -> DataFrame:
    """AGG10: rows and distinct files per shard."""
    return sharded.groupBy("shard_id").agg(F.count(F.lit(1)).alias("rows"),
                                           F.count_distinct(file).alias("files"))


def shard_plan(df: DataFrame, num_shards: int) -> DataFrame:
    """AGG11: samples per shard and remainder, computed from one count."""
    c = df.agg(F.count(F.lit(1)).alias("n"))
    return c.select("n", F.lit(num_shards).alias("num_shards"),
                    F.floor(F.col("n") / num_shards).cast("long").alias("samples_per_shard"),
                    (F.col("n") % num_shards).cast("long").alias("remainder"))


def take_first(df: DataFrame, n: int, order) -> DataFrame:
    """LIM1: the first ``n`` rows in a defined order (-1 = all).  A sort + limit is a
    top-k (``TakeOrderedAndProject``), not a full sort."""
    return df if n < 0 else df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int, seed: int, key: str = "utt_id") -> DataFrame:
    """LIM2: ``n`` rows chosen by hash order (deterministic, top-k)."""
    return df.orderBy(*shuffle_key(seed, key)).limit(n)
