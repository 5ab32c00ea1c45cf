"""Structured Streaming forms of the manifest jobs (STR1-STR4).

Manifests carry no event time, so there are no watermarks or windows here: streams are
new manifest files arriving in a folder.  Sinks are exactly-once file sinks or
``foreachBatch`` writers that are idempotent by batch id; checkpoints live under the
shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import text as X
from ..operators import shards as H
from ..operators import wer as W
from ..session import scratch_path, scratch_scope, written
from ..sinks import shards as KS
from ..sinks.shards import put_if_absent
from ..sources.manifest import parse_lines


def stream_manifest(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """STR1: manifest files arriving in ``path`` -> clean rows (stateless), by the batch reader's rules: keys
    that are not known are kept in ``custom``, a line that is no JSON object is a flagged row
    (``is_error``) with its ``line``."""
    s = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    s = parse_lines(s.select("value"))
    return (s.withColumn("audio_filepath", F.coalesce("audio_filepath", "audio_file"))
             .withColumn("text", X.clean_text("text")).drop("audio_file", "has_text_key"))


def run_with_quarantine(rows: DataFrame, out: str) -> str:
    """Runs a stream of ``stream_manifest`` over everything available into two tables, ``rows`` and
    ``flagged`` (the bad lines), which stay in step: each batch writes its folder in both, over what a
    crashed attempt left, and counts once its commit file is there."""
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int):
        if committed(spark, out).where(F.col("batch_id") == batch_id).limit(1).count():
            return
        with scratch_scope(spark):
            once = written(batch, "batch")
            once.where("not is_error").drop("is_error", "line").write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")
            once.where("is_error").select("line").write.mode("overwrite").parquet(f"{out}/flagged/batch_id={batch_id}")
        put_if_absent(spark, f"{out}/commits/{batch_id}.json", f'{{"batch_id": {batch_id}}}')

    q = (rows.writeStream.foreachBatch(write).option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def committed(spark: SparkSession, out: str) -> DataFrame:
    """The batches that both tables hold: (batch_id)."""
    try:
        return spark.read.schema("batch_id long").option("pathGlobFilter", "*.json").json(f"{out}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "batch_id long")


def read_quarantined(spark: SparkSession, out: str, table: str) -> DataFrame:
    """``rows`` or ``flagged``, committed batches only."""
    return spark.read.parquet(f"{out}/{table}").join(committed(spark, out), "batch_id", "left_semi")


def stream_dedup(df: DataFrame, col: str = "text", event_time: str | None = None,
                 delay: str = "1 hour") -> DataFrame:
    """STR2: incremental corpus dedup on ``sha2(strip(text))``.  Without an ingest time
    the state keeps every key seen (like the corpus set); with ``event_time`` the state
    is bounded by the watermark (``dropDuplicatesWithinWatermark``)."""
    t = X.py_strip(col)
    d = df.filter(F.col(col).isNotNull() & (F.col(col) != "")).withColumn("text", t) \
        .filter(F.col("text") != "").withColumn("text_key", F.sha2("text", 256))
    if event_time:
        return d.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["text_key"])
    return d.dropDuplicates(["text_key"])


def run_to_files(df: DataFrame, out: str, fmt: str = "parquet") -> str:
    """Run a stream over everything available (``availableNow``) into a file sink."""
    spark = df.sparkSession
    q = (df.writeStream.format(fmt).option("path", out)
         .option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def stream_wer(pairs: DataFrame, by: list[str]) -> DataFrame:
    """STR3: running corpus WER per group (run/epoch key: a new key resets it)."""
    scored = W.score_pairs(pairs)
    return W.wer(scored, by)


def run_complete(df: DataFrame, out: str) -> str:
    """Complete-mode aggregate: each micro-batch rewrites the result table."""
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(out)

    q = (df.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def stream_append(df: DataFrame, root: str, per_shard: int, first_shard: int, seed: int = 42):
    """STR4: each micro-batch, with the rows that the one before left over, is appended as
    new shards (WIN2) with a new metadata version (SNK6).  Rows go to
    ``manifest/batch_id=<id>`` and those short of a shard to ``remainder/batch_id=<id>``,
    both overwritten on replay.  The metadata record is written last and holds the batch
    id, so a batch whose record exists is skipped, and one that crashed before writing it
    is done again from the same state."""
    spark = df.sparkSession
    meta = f"{root}/metadata"

    def append(batch: DataFrame, batch_id: int):
        done = KS.read_versions(spark, meta).filter(F.col("batch_id").isNotNull())
        last, shards = done.agg(F.max("batch_id"), F.max("dataset_config.num_shards")).first()
        if last is not None and batch_id <= last:
            return
        if last is not None:
            left = spark.read.schema(batch.schema).parquet(f"{root}/remainder/batch_id={last}")
            batch = batch.unionByName(left)
        first = int(shards) if shards is not None else first_shard
        with scratch_scope(spark):                 # nothing of a batch is left behind
            kept, rest = H.shard_append(batch, per_shard, first, H.shuffle_key(seed))
            kept.drop("idx").write.mode("overwrite").parquet(f"{root}/manifest/batch_id={batch_id}")
            rest.drop("idx").write.mode("overwrite").parquet(f"{root}/remainder/batch_id={batch_id}")
        added = spark.read.parquet(f"{root}/manifest/batch_id={batch_id}").select("shard_id").distinct().count()
        KS.append_version(spark, meta, {"num_shards": first + added, "shuffle": True, "shuffle_seed": seed},
                          per_shard, True, batch_id)

    q = (df.writeStream.foreachBatch(append)
         .option("checkpointLocation", scratch_path(spark, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return meta
