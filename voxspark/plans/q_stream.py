"""Queries: streaming manifest cleaning, dedup, running WER, shard append (STR1-STR4).
Each stream runs to completion over files derived from the driver tables
(``availableNow``) and its sink is read back as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shards as H
from ..session import scratch_path
from ..streaming import manifest as ST
from . import views as V
from .registry import query

MANIFEST = V.with_views("v_manifest")


def _arriving(spark, df, n_files: int = 5) -> str:
    """Write ``df`` as ``n_files`` JSON files in a fresh folder (hash by utt_id)."""
    path = scratch_path(spark, "incoming")
    df.repartition(n_files, "utt_id").write.json(path)
    return path


@query("str1_stream_manifest", covers=("STR1", "SCL8"),
       sql=f"""{MANIFEST}
SELECT utt_id, split, {V.sql_clean_text('text')} AS text, duration, dataset AS corpus, NULL AS line FROM v_manifest
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, regexp_replace(text, '[\\r\\n]+', ' ', 'g') FROM benchmark""")
def str1_stream_manifest(spark, sf):
    """Manifest rows with a key of their own (``corpus``) arrive between lines that are no JSON."""
    m = V.v_manifest(spark, sf).withColumnRenamed("dataset", "corpus")
    lines = m.select("utt_id", F.to_json(F.struct(*m.columns)).alias("value")).unionByName(
        V.table(spark, sf, "benchmark").select(F.concat(F.lit("bad"), "item_id").alias("utt_id"),
                                               F.regexp_replace("text", "[\\r\\n]+", " ").alias("value")))
    src = scratch_path(spark, "incoming")
    lines.repartition(5, "utt_id").select("value").write.text(src)
    out = ST.run_with_quarantine(ST.stream_manifest(spark, src), scratch_path(spark, "str1"))
    rows = ST.read_quarantined(spark, out, "rows").select("utt_id", "split", "text", "duration", F.col("custom")["corpus"].alias("corpus"),
                                                          F.lit(None).cast("string").alias("line"))
    flagged = ST.read_quarantined(spark, out, "flagged").select("line")
    return rows.unionByName(flagged, allowMissingColumns=True)


@query("str2_stream_dedup", covers=("STR2", "SET3"),
       sql=f"""SELECT DISTINCT t AS text, sha256(t) AS text_key FROM (
  SELECT {V.sql_strip('text')} AS t FROM documents WHERE text IS NOT NULL AND text <> ''
  UNION ALL SELECT {V.sql_strip('text')} FROM conversations WHERE text IS NOT NULL AND text <> '')
WHERE t <> ''""")
def str2_stream_dedup(spark, sf):
    docs = V.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("utt_id"), "text")
    conv = V.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("utt_id"), "text")
    src = _arriving(spark, docs.unionByName(conv))
    s = spark.readStream.schema("utt_id string, text string").option("maxFilesPerTrigger", 1).json(src)
    out = ST.run_to_files(ST.stream_dedup(s), scratch_path(spark, "str2"))
    return spark.read.parquet(out).select("text", "text_key")


@query("str3_stream_wer", covers=("STR3", "AGG1"))
def str3_stream_wer(spark, sf):
    pairs = V.v_pairs(spark, sf).select("utt_id", "split", "prediction", "reference")
    src = _arriving(spark, pairs)
    s = (spark.readStream.schema("utt_id string, split string, prediction string, reference string")
         .option("maxFilesPerTrigger", 1).json(src))
    out = ST.run_complete(ST.stream_wer(s, ["split"]), scratch_path(spark, "str3"))
    return spark.read.parquet(out).select("split", "edits", "words", "rows", F.round("wer", 6).alias("wer"))


@query("str3_stream_wer_turns", covers=("STR3", "AGG1"),
       sql=f"""{V.sql_turn_edits()} SELECT role, CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(words) AS BIGINT) AS words,
       count(*) AS rows, CASE WHEN sum(words) = 0 THEN CAST('inf' AS DOUBLE) ELSE round(sum(edits) / sum(words), 6) END AS wer
FROM scored WHERE kind = 'np' GROUP BY role""")
def str3_stream_wer_turns(spark, sf):
    src = _arriving(spark, V.v_turn_pairs(spark, sf))
    s = (spark.readStream.schema("role string, prediction string, reference string")
         .option("maxFilesPerTrigger", 1).json(src))
    out = ST.run_complete(ST.stream_wer(s, ["role"]), scratch_path(spark, "str3t"))
    return spark.read.parquet(out).select("role", "edits", "words", "rows", F.round("wer", 6).alias("wer"))


@query("str4_stream_append", covers=("STR4", "WIN2", "SNK6"),
       sql=f"""{MANIFEST},
n AS (SELECT count(*) FILTER (split = 'train') // 10 AS per, count(*) FILTER (split <> 'train') AS new FROM v_manifest)
SELECT CAST(10 + i AS INTEGER) AS shard_id, per AS rows FROM (SELECT per, unnest(range(new // per)) AS i FROM n)
UNION ALL SELECT -1 AS shard_id, new % per AS rows FROM n""")
def str4_stream_append(spark, sf):
    """Appended shards with their rows; the rows that wait for the next batch as shard -1."""
    m = V.v_manifest(spark, sf)
    base = m.filter(F.col("split") == "train")
    per = int(H.shard_plan(base, 10).first()["samples_per_shard"])
    src = _arriving(spark, m.filter(F.col("split") != "train"))
    s = (spark.readStream.schema("utt_id string, split string, duration double, text string")
         .option("maxFilesPerTrigger", 1).json(src))
    root = scratch_path(spark, "str4")
    meta = ST.stream_append(s, root, per, 10)
    from ..sinks.shards import read_versions
    last = read_versions(spark, meta).agg(F.max("batch_id")).first()[0]
    shards = spark.read.parquet(f"{root}/manifest").groupBy("shard_id").agg(F.count(F.lit(1)).alias("rows"))
    left = spark.read.parquet(f"{root}/remainder/batch_id={last}").agg(
        F.lit(-1).alias("shard_id"), F.count(F.lit(1)).alias("rows"))
    return shards.unionByName(left)
