"""Versioned data-set metadata (SNK6, SCL19) and shard manifests without audio (SNK4).

A data set's metadata is a folder of numbered JSON records.  A version is committed by putting its
record in place only if that number is absent, in one atomic step; whoever comes second reads
the new latest version and tries again, so no two writers ever commit the same number and
readers see whole records only.
"""

from __future__ import annotations

import json
import os
import random
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import hadoop_path

# Fixed value: created-time format of the metadata record.
STAMP_FORMAT = "MM-dd-yyyy HH-mm-ss"

CONFIG_DDL = ("num_shards int, shuffle boolean, max_duration double, min_duration double, "
              "shuffle_seed int, sort_in_shards boolean, shard_manifests boolean, "
              "keep_files_together boolean, force_codec string, use_lhotse boolean, "
              "use_bucketing boolean, num_buckets int, bucket_duration_bins array<double>")
RECORD_DDL = (f"version int, created_datetime string, num_samples_per_shard int, "
              f"is_concatenated_manifest boolean, dataset_config struct<{CONFIG_DDL}>")
# batch_id: the micro-batch that wrote the record, null for batch jobs; build: the folder, under the
# data set's, of the shards that the version added
META_DDL = f"{RECORD_DDL}, history array<struct<{RECORD_DDL}>>, batch_id long, build string"

# The configuration of a blank record.
DEFAULT_CONFIG = {"num_shards": -1, "shuffle": False, "max_duration": None,
                  "min_duration": None, "shuffle_seed": None, "sort_in_shards": True,
                  "shard_manifests": True, "keep_files_together": False, "force_codec": None,
                  "use_lhotse": False, "use_bucketing": False, "num_buckets": None,
                  "bucket_duration_bins": None}


def stamp(at: Column | None = None) -> Column:
    """SCL19: a time (now, if none is given) as ``MM-dd-yyyy HH-mm-ss``."""
    return F.date_format(F.current_timestamp() if at is None else at, STAMP_FORMAT)


def write_shards(df: DataFrame, path: str, shard_manifests: bool = True,
                 mode: str = "overwrite") -> str:
    """SNK4 without audio: one manifest per shard, rows in shard order (``pos``), or one folder for
    all; ``audio_filepath`` is the member name inside the shard.  A manifest is a folder of part
    files that follow each other by name: a shard is cut by ranges of ``pos``, so that no task
    takes a shard whole.  The folder of the shard manifests, read whole, is the aggregate: it is
    written once."""
    out = df.withColumn("audio_filepath", F.col("member")).drop("member")
    ordered = out.repartitionByRange("shard_id", "pos").sortWithinPartitions("shard_id", "pos")
    if shard_manifests:
        ordered.write.mode(mode).partitionBy("shard_id").json(f"{path}/sharded_manifests")
    else:
        ordered.write.mode(mode).json(f"{path}/tarred_audio_manifest")
    return path


# ------------------------------------------------------------------ versions
class VersionTaken(RuntimeError):
    """Another writer has committed the version that was to be written."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; False if it was.  Readers see all of it or nothing: a hidden
    file is written first, then linked (local) or renamed without overwriting (``FileContext``,
    atomic on HDFS; an object store needs a committer of its own)."""
    fs, p = hadoop_path(spark, path)
    p = p.makeQualified(fs.getUri(), fs.getWorkingDirectory())
    jvm, folder = spark._jvm, p.getParent()
    hidden = jvm.org.apache.hadoop.fs.Path(folder, f".{p.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(folder)
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(hidden.toUri().getPath(), p.toUri().getPath())
        else:
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(hidden, p, options)
        return True
    except FileExistsError:
        return False
    except Exception as e:                                # py4j wraps the Java exception
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    finally:
        fs.delete(hidden, False)


def _file(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{version:08d}.json"


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META_DDL).option("pathGlobFilter", "*.json").json(path)


def read_versions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All metadata records, or those up to ``version``; none only if the data set does not exist yet."""
    try:
        out = _records(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        out = spark.createDataFrame([], META_DDL)
    return out if version is None else out.where(F.col("version") <= version)


def latest_version(spark: SparkSession, path: str) -> dict | None:
    """The newest record as a dictionary."""
    fs, p = hadoop_path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    numbers = [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        return None
    rows = spark.read.text(_file(path, max(numbers)), wholetext=True).collect()        # one record
    return json.loads(rows[0].value)


def config(**given) -> dict:
    """A whole configuration: the blank one with ``given`` in place."""
    unknown = set(given) - set(DEFAULT_CONFIG)
    if unknown:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    return {**DEFAULT_CONFIG, **given}


def blank() -> dict:
    """SNK6: the blank record of a new data set (version 0, no samples per shard yet)."""
    return {"version": 0, "created_datetime": None, "num_samples_per_shard": None, "is_concatenated_manifest": False,
            "dataset_config": dict(DEFAULT_CONFIG), "history": [], "batch_id": None, "build": None}


def default_record(spark: SparkSession) -> DataFrame:
    """SNK6: the blank record as a row, with its created time."""
    return spark.createDataFrame([json.dumps(blank())], "string").select(
        F.from_json("value", META_DDL).alias("r")).select("r.*").withColumn("created_datetime", stamp())


def commit_version(spark: SparkSession, path: str, cfg: dict, num_samples_per_shard: int | None, concatenated: bool,
                   version: int, before: dict | None, batch_id: int | None = None, build: str | None = None) -> dict:
    """Put the record of ``version`` in place; ``VersionTaken`` if it is there already."""
    keep = ("version", "created_datetime", "num_samples_per_shard", "is_concatenated_manifest", "dataset_config")
    history = [*before["history"], {k: before.get(k) for k in keep}] if before else []
    record = {"version": version, "created_datetime": spark.range(1).select(stamp()).first()[0],
              "num_samples_per_shard": num_samples_per_shard, "is_concatenated_manifest": concatenated,
              "dataset_config": config(**cfg), "history": history, "batch_id": batch_id, "build": build}
    if not put_if_absent(spark, _file(path, version), json.dumps(record)):
        raise VersionTaken(f"{path}: version {version}")
    return record


def append_version(spark: SparkSession, path: str, cfg: dict, num_samples_per_shard: int,
                   concatenated: bool, batch_id: int | None = None, attempts: int = 50) -> DataFrame:
    """SNK6: append version ``latest + 1`` (1 for the first) holding the config, samples per shard,
    the concatenated flag, the created time and the earlier versions as history.  Where another
    writer was faster, the next number is tried."""
    for k in range(attempts):
        before = latest_version(spark, path)
        try:
            commit_version(spark, path, cfg, num_samples_per_shard, concatenated, before["version"] + 1 if before else 1, before, batch_id)
            return read_versions(spark, path)
        except VersionTaken:
            time.sleep(random.uniform(0, 0.05 * (k + 1)))
    raise VersionTaken(f"{path}: {attempts} attempts")
