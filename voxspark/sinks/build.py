"""The sharder as one job: from a manifest and an audio store to tars, shard manifests and a version
(FLT1, WIN1-WIN5, PRJ8, PRJ9, JOIN5, SNK4-SNK6), appending to a data set, reading it back and
exporting a subset of it (SRC9, JOIN1, JOIN2, WIN3, PRJ10).

A data set is a folder: ``metadata/<version>.json`` and a folder ``build-<id>`` for the shards that a version
added.  A version names its folder, so nothing is read that no version names: a build that
fails, or loses the race for its version, leaves the data set as it was.

Shards are planned over the manifest's key, file and duration alone; texts and audio bytes join the
plan last and are shuffled by shard once.  The bytes of a file go to a shard once, however many
rows name it.
"""

from __future__ import annotations

import random
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import manifest as M
from ..operators import shards as H
from ..session import hadoop_path, written
from ..sources import shards as SS
from . import shards as KS
from . import tar as T


def plan_shards(rows: DataFrame, cfg: dict, per_shard: int | None = None, first_shard: int = 0,
                key: str = "utt_id") -> tuple[DataFrame, int, int]:
    """``(plan, shards, rows per shard)``; the plan has ``key``, ``shard_id``, ``pos``, ``member`` and ``repeat``.  Even shards
    (``num_shards``), or shards of ``per_shard`` rows numbered on from ``first_shard``; what does not
    fill a shard is left out."""
    kept, _ = M.filter_duration(rows, cfg["min_duration"], cfg["max_duration"])
    narrow = kept.select(key, "audio_filepath", "duration")
    seed = cfg["shuffle_seed"] or 0
    if not cfg["shuffle"]:
        order = [F.col(key)]
    elif cfg["keep_files_together"]:
        order = H.file_shuffle_key(seed, idx=key)
    else:
        order = H.shuffle_key(seed, key)
    if per_shard is None:
        dealt, left = H.shard_even(narrow, cfg["num_shards"], order)
        shards = cfg["num_shards"]
    else:
        dealt, left = H.shard_append(narrow, per_shard, first_shard, order)
        shards = None
    plan = written(H.number_repeats(H.order_in_shard(dealt, cfg["sort_in_shards"])).select(
        key, "audio_filepath", "shard_id", "pos", "member", "repeat"), "plan")
    n = plan.count()
    if shards is None:
        shards = n // per_shard
    return plan, shards if n else 0, n // shards if n and shards else 0


def _check_name(name: str) -> None:
    if name in ("content", "entry"):
        raise ValueError(f"a manifest column can't be named {name}")


def write_planned(rows: DataFrame, plan: DataFrame, files: DataFrame, path: str, shard_manifests: bool = True, key: str = "utt_id") -> None:
    """Tars and shard manifests of a plan.  A row keeps all its columns in the manifest, with the member as
    ``audio_filepath`` and its ``shard_id``; a file that the store does not hold fails the write."""
    for c in rows.columns:
        _check_name(c)
    out = rows.drop("shard_id", "member", "pos", "repeat", "audio_filepath").join(plan, key)
    kept = [F.col(c) for c in rows.columns if c not in ("shard_id", "member", "pos", "repeat", "audio_filepath")]
    out = out.withColumn("entry", F.to_json(F.struct(*kept, F.col("member").alias("audio_filepath"), "shard_id")))
    out = out.select("shard_id", "pos", "member", "repeat", "audio_filepath", "entry")
    # the bytes go with the first row of a file in its shard only
    audio = files.select(F.col("path").alias("_path"), F.col("content").alias("_bytes"))
    out = out.join(audio, (F.col("repeat") == 0) & (F.col("audio_filepath") == F.col("_path")), "left")
    missing = F.raise_error(F.concat(F.lit("audio file not found: "), F.coalesce("audio_filepath", F.lit("null")))).cast("binary")
    out = out.withColumn("content", F.when((F.col("repeat") == 0) & F.col("_bytes").isNull(), missing).otherwise(F.col("_bytes")))
    T.write_tar_shards(out, path, manifests=shard_manifests)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def create(rows: DataFrame, files: DataFrame, root: str, cfg: dict, key: str = "utt_id") -> dict:
    """A new data set, version 0: its metadata record, or none and no data set where no row is left."""
    spark, cfg = rows.sparkSession, KS.config(**cfg)
    if cfg["num_shards"] < 1:
        raise ValueError("num_shards must be >= 1")
    plan, shards, per = plan_shards(rows, cfg, key=key)
    if not shards:
        return {}
    name = f"build-{uuid.uuid4().hex}"
    write_planned(rows, plan, files, f"{root}/{name}", cfg["shard_manifests"], key)
    try:
        return KS.commit_version(spark, f"{root}/metadata", cfg, per, False, 0, None, build=name)
    except KS.VersionTaken:
        _drop(spark, f"{root}/{name}")
        raise


def append(rows: DataFrame, files: DataFrame, root: str, key: str = "utt_id", attempts: int = 20) -> dict:
    """The next version: full shards of ``rows``, of the size and configuration of the data set, ids going on.  Where
    another writer commits first, its shards take those ids: the plan is numbered on from there
    and written again."""
    spark = rows.sparkSession
    for k in range(attempts):
        before = KS.latest_version(spark, f"{root}/metadata")
        if before is None:
            raise ValueError(f"{root} is no data set")
        cfg, per = before["dataset_config"], before["num_samples_per_shard"]
        plan, shards, _ = plan_shards(rows, cfg, per, cfg["num_shards"], key)
        if not shards:
            return {}
        name = f"build-{uuid.uuid4().hex}"
        write_planned(rows, plan, files, f"{root}/{name}", cfg["shard_manifests"], key)
        try:
            return KS.commit_version(spark, f"{root}/metadata", {**cfg, "num_shards": cfg["num_shards"] + shards}, per, True,
                                     before["version"] + 1, before, build=name)
        except KS.VersionTaken:
            _drop(spark, f"{root}/{name}")
            time.sleep(random.uniform(0, 0.1 * (k + 1)))
    raise KS.VersionTaken(f"{root}: {attempts} attempts")


def folders(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """The folders of a data set's shards, at a version or the latest: a name a version."""
    got = KS.read_versions(spark, f"{root}/metadata", version).where("build is not null").select("build").collect()
    return [f"{root}/{r.build}" for r in got]


def shard_list(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``shard_id, rows, files, bytes``, as the writers counted them."""
    paths = [f"{f}/{T.SHARDS}" for f in folders(spark, root, version)]
    return spark.read.schema("shard_id int, rows long, files long, bytes long").json(paths)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """SRC9 + SRC10: manifest rows of a data set, paired with the members of its tars; audio bytes by
    ``sources.shards.attach_content``."""
    at = folders(spark, root, version)
    return SS.pair(SS.read_entries(spark, at), SS.tar_index(spark, at))


def export_subset(spark: SparkSession, root: str, keep: DataFrame, path: str, order: str, shard_size: int = 1000,
                  key: str = "utt_id", version: int | None = None) -> str:
    """The rows of a data set whose id ``keep`` names, with its custom fields (of the last row of an id by its
    column ``order``), as shards of ``shard_size``: only their bytes are read.  Members are ``<id>`` with the extension of their audio, which is not
    transcoded; rows follow the id."""
    rows = read(spark, root, version)
    rows = J.attach_custom(rows, keep, key, order=order).drop("shard_id")
    named = H.shard_fixed(M.export_rows(rows, key), shard_size, [key]).withColumn("pos", F.col("idx"))
    member = F.concat(F.col(key), M.path_ext(F.col("member")))
    fields = F.from_json("export", "map<string,string>")
    fields = F.map_concat(F.map_filter(fields, lambda k, _: ~k.isin("audio_filepath", "shard_id", "duration", key)), F.create_map(
        F.lit("audio_filepath"), member, F.lit(key), F.col(key)))
    # numbers stay numbers; a custom field of that name overrides the length
    seconds = F.coalesce(F.col("custom")["duration"], F.col("duration").cast("string"), F.lit("null"))
    entry = F.concat(F.lit('{"shard_id":'), "shard_id", F.lit(',"duration":'), seconds, F.lit(","), F.substring(F.to_json(fields), 2, 1 << 30))
    out = named.withColumn("entry", entry).withColumn("member", member)
    return T.write_tar_shards(SS.attach_content(out.select("shard_id", "pos", "member", "entry", "tar", "tar_offset", "size")), path)
