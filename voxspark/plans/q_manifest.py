"""Queries: manifest sources and sinks, projections, filters, set operations, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import manifest as M
from ..session import hadoop_path, scratch_path, written
from ..sinks.shards import put_if_absent
from ..sinks import manifest as K
from ..sources import manifest as S
from . import views as V
from .registry import query, r6

MANIFEST = V.with_views("v_manifest")
TOKENS = V.with_views("v_tokens")
MCOLS = ["utt_id", "dataset", "split", "audio_filepath", "duration", "text",
         "source_lang", "target_lang", "taskname", "pnc"]


def _bad_lines(spark, sf):
    """Lines that are not JSON objects (benchmark passages as raw text)."""
    return V.table(spark, sf, "benchmark").select(
        F.regexp_replace("text", "[\\r\\n]+", " ").alias("value"))


@query("src1_read_manifest", covers=("SRC1", "SNK1", "SCL14", "SCL15"),
       sql=f"{MANIFEST}\nSELECT {', '.join(MCOLS)} FROM v_manifest")
def src1_read_manifest(spark, sf):
    m = V.v_manifest(spark, sf)
    root = scratch_path(spark, "src1")
    K.write_manifest(m, f"{root}/manifest")
    _bad_lines(spark, sf).write.text(f"{root}/bad")
    df = S.read_manifest(spark, [f"{root}/manifest", f"{root}/bad"])
    return df.select(*MCOLS)


@query("src2_scan_manifests", covers=("SRC2", "SNK2", "FLT6"),
       sql=f"""{MANIFEST}
SELECT dataset, split, count(*) AS rows, sum(duration) AS seconds
FROM v_manifest WHERE dataset NOT IN ('src0', 'src1') GROUP BY dataset, split""")
def src2_scan_manifests(spark, sf):
    root = scratch_path(spark, "datasets")
    K.write_manifest(V.v_manifest(spark, sf), root, partition_by=("dataset", "split"))
    df = S.scan_manifests(spark, root, exclude=["src0", "src1"])
    return df.groupBy("dataset", "split").agg(F.count(F.lit(1)).alias("rows"),
                                             F.sum("duration").alias("seconds"))


@query("src4_text_corpus", covers=("SRC4", "TOK1"),
       sql=f"""SELECT word, count(*) AS count FROM (SELECT unnest({V.sql_raw_words('lower(text)')}) AS word FROM documents
  UNION ALL SELECT unnest({V.sql_raw_words('lower(text)')}) FROM conversations) GROUP BY word""")
def src4_text_corpus(spark, sf):
    """Plain text files, some of them manifests' texts, as a vocabulary's corpus."""
    from ..operators import vocab as VO
    root = scratch_path(spark, "src4t")
    for name in ("documents", "conversations"):
        K.write_corpus(V.table(spark, sf, name), f"{root}/{name}")
    return VO.word_freq(S.read_texts(spark, f"{root}/documents,{root}/conversations"))


@query("src4_manifest_list", covers=("SRC3", "SRC4", "SRC10"),
       sql=f"""{MANIFEST}
SELECT split, source_lang, count(*) AS rows FROM v_manifest GROUP BY split, source_lang""")
def src4_manifest_list(spark, sf):
    m = V.v_manifest(spark, sf)
    root = scratch_path(spark, "src4")
    for sp in ("train", "validate", "test"):
        K.write_manifest(m.filter(F.col("split") == sp), f"{root}/{sp}", partition_by=())
    df = S.read_manifest(spark, f"{root}/train/*.json,{root}/validate,{root}/test")
    return df.groupBy("split", "source_lang").agg(F.count(F.lit(1)).alias("rows"))


@query("src6_mix", covers=("SRC5", "SRC6"),
       sql=f"""{MANIFEST}
SELECT utt_id, 0 AS source_index FROM v_manifest
 WHERE split = 'train' AND CAST(('0x' || substr(md5(utt_id), 1, 8)) AS BIGINT) / 4294967296.0 < 1.0
UNION ALL
SELECT utt_id, 1 AS source_index FROM v_manifest
 WHERE split <> 'train' AND CAST(('0x' || substr(md5(utt_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.25""")
def src6_mix(spark, sf):
    m = V.v_manifest(spark, sf)
    root = scratch_path(spark, "src6")
    K.write_manifest(m.filter(F.col("split") == "train"), f"{root}/a", partition_by=())
    K.write_manifest(m.filter(F.col("split") != "train"), f"{root}/b", partition_by=())
    return S.read_inputs(spark, [[f"{root}/a", 2.0], [f"{root}/b", 0.5]]).select("utt_id", F.col("source_index").cast("int"))


def _kept_sql(i: int, where: str, share: float) -> str:
    return (f"SELECT utt_id, {i} AS source_index, {'lang' if i == 2 else 'NULL'} AS field FROM (SELECT *, source_lang AS lang FROM v_manifest) "
            f"WHERE {where} AND CAST(('0x' || substr(md5(utt_id), 1, 8)) AS BIGINT) / 4294967296.0 < {share}")


@query("src5_input_forms", covers=("SRC5", "SRC6"),
       sql=f"""{MANIFEST}
{' UNION ALL '.join(_kept_sql(i, w, x) for i, (w, x) in enumerate([
    ("split = 'train'", 1.0), ("split = 'test'", 0.5), ("split = 'validate'", 0.75)]))}""")
def src5_input_forms(spark, sf):
    """A nested configuration: a manifest, a list in a group of half the weight, and a shard directory whose
    field files are zipped by line."""
    m = V.v_manifest(spark, sf)
    root = scratch_path(spark, "src5")
    K.write_manifest(m.where("split = 'train'"), f"{root}/a", partition_by=())
    K.write_manifest(m.where("split = 'test'"), f"{root}/b", partition_by=())
    cuts = m.where("split = 'validate'").repartition(3, "utt_id").sortWithinPartitions("utt_id")
    parts = cuts.select("utt_id", F.to_json(F.struct("utt_id", "duration", "text", "split")).alias("cuts"), F.col("source_lang").alias("language"),
                        F.format_string("%06d", F.spark_partition_id()).alias("n"))
    parts = written(parts, "src5-parts")
    for field in ("cuts", "language"):
        parts.select("n", "utt_id", field).repartition("n").sortWithinPartitions("n", "utt_id").select("n", F.col(field).alias("value")) \
            .write.partitionBy("n").text(f"{root}/{field}")
    fs, _ = hadoop_path(spark, root)
    where = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(where(f"{root}/shar"))
    for field in ("cuts", "language"):                    # files are named as shard directories name them
        for found in fs.globStatus(where(f"{root}/{field}/n=*/part-*.txt")):
            n = found.getPath().getParent().getName()[2:]
            fs.rename(found.getPath(), where(f"{root}/shar/{field}.{int(n):06d}.jsonl"))
    config = (f"input_cfg:\n- manifest_filepath: {root}/a\n  weight: 2\n- weight: 0.5\n  input_cfg:\n"
              f"  - manifest_filepath: {root}/b\n    weight: 2\n  - input_cfg:\n    - {{shar_path: {root}/shar, weight: 1.5}}\n    weight: 2\n")
    put_if_absent(spark, f"{root}/in.yaml", config)
    rows = S.read_inputs(spark, f"input_cfg={root}/in.yaml")
    return rows.select("utt_id", F.col("source_index").cast("int"), F.col("custom")["language"].alias("field"))


def _nested_source(spark, sf):
    """Nested source rows derived from ``documents``: audio struct (path under
    ``extracted/<hash>/``, samples, rate 16) and a JSON struct with the text."""
    d = V.table(spark, sf, "documents")
    split = F.when(F.col("doc_id") % 10 == 0, "test").when(F.col("doc_id") % 10 == 1,
                                                            "validate").otherwise("train")
    path = F.concat(F.lit("/cache/hub/extracted/"), F.md5("source"), F.lit("/"), F.col("lang"),
                    F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp3"))
    return d.select(
        F.col("doc_id").cast("string").alias("__key__"),
        F.concat(F.lit("hub://"), "source").alias("__url__"),
        F.struct(path.alias("path"),
                 F.array_repeat(F.lit(0.0).cast("float"), F.col("n_chars").cast("int")).alias("array"),
                 F.lit(16).alias("sampling_rate")).alias("mp3"),
        F.struct(F.col("text").alias("text")).alias("json"),
        split.alias("split"),
        F.col("doc_id").cast("string").alias("utt_id"))


SRC7_SQL = f"""SELECT CAST(doc_id AS VARCHAR) AS utt_id, split,
       './datasets/corpus/' || split || '/audio/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.wav' AS audio_filepath,
       CAST(n_chars AS DOUBLE) / 16.0 AS duration, {V.sql_clean_text('text')} AS text,
       'ru' AS source_lang, 'ru' AS target_lang, 'asr' AS taskname, 'yes' AS pnc
FROM (SELECT *, CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validate' ELSE 'train' END AS split
      FROM documents)"""


@query("src7_to_manifest", covers=("SRC7", "PRJ1", "PRJ2", "PRJ3", "PRJ4", "PRJ5", "SCL8"),
       sql=SRC7_SQL)
def src7_to_manifest(spark, sf):
    return S.to_manifest(_nested_source(spark, sf), "corpus")


@query("src8_all_splits", covers=("SRC8",),
       sql=f"""SELECT split, count(*) AS rows, sum(duration) AS seconds FROM ({SRC7_SQL}) GROUP BY split""")
def src8_all_splits(spark, sf):
    m = S.to_manifest(_nested_source(spark, sf), "corpus")
    return m.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("duration").alias("seconds"))


@query("prj1_defaults", covers=("PRJ1", "PRJ12"),
       sql=f"""{MANIFEST}
SELECT utt_id, coalesce(CASE WHEN source_lang = 'en' THEN NULL ELSE source_lang END, 'ru') AS source_lang,
       target_lang, 'asr' AS taskname, 'yes' AS pnc, text AS transcript
FROM v_manifest""")
def prj1_defaults(spark, sf):
    m = V.v_manifest(spark, sf).drop("taskname", "pnc")
    m = m.withColumn("source_lang", F.when(F.col("source_lang") != "en", F.col("source_lang")))
    return M.with_defaults(m).select("utt_id", "source_lang", "target_lang", "taskname", "pnc",
                                     F.col("text").alias("transcript"))


@query("prj8_paths", covers=("PRJ6", "PRJ7", "PRJ8", "PRJ9"),
       sql=f"""{MANIFEST}
SELECT utt_id, '/data/manifests/' || audio_filepath AS resolved,
       replace(replace(regexp_replace(audio_filepath, '\\.wav$', ''), '/', '_'), '.', '_') || '.wav' AS squashed,
       CAST(doc_id % 7 AS INTEGER) AS shard_id
FROM v_manifest""")
def prj8_paths(spark, sf):
    m = V.v_manifest(spark, sf, keep_doc_id=True).withColumn("audio_file", F.lit(None).cast("string"))
    m = m.withColumn("line", F.lit(None).cast("string"))
    m = S.audio_key(m)
    m = m.withColumn("resolved", M.resolve_path(F.col("audio_filepath"),
                                                F.lit("/data/manifests/train_manifest.jsonl")))
    m = m.withColumns({"squashed": M.squash(F.col("audio_filepath")),
                       "shard_id": (F.col("doc_id") % 7).cast("int")})
    return m.select("utt_id", "resolved", "squashed", "shard_id")


@query("prj14_tps", covers=("PRJ3", "PRJ14"),
       sql=f"""{TOKENS}
SELECT utt_id, tokens, round(tokens / duration, 6) AS tps FROM v_tokens""")
def prj14_tps(spark, sf):
    t = V.v_tokens(spark, sf)
    return t.select("utt_id", "tokens", r6(M.tps(F.col("tokens"), F.col("duration"))).alias("tps"))


@query("flt1_filter_duration", covers=("FLT1", "SET4"),
       sql=f"""{MANIFEST}
SELECT utt_id, duration >= 20.0 AND duration < 250.0 AS kept FROM v_manifest""")
def flt1_filter_duration(spark, sf):
    m = V.v_manifest(spark, sf)
    kept, rest = M.filter_duration(m, 20.0, 250.0)
    return (kept.select("utt_id", F.lit(True).alias("kept"))
            .unionByName(rest.select("utt_id", F.lit(False).alias("kept"))))


@query("flt2_closed_filter", covers=("FLT2",),
       sql=f"""{MANIFEST}
SELECT utt_id FROM v_manifest WHERE duration BETWEEN 20.0 AND 250.0""")
def flt2_closed_filter(spark, sf):
    kept, _ = M.filter_duration(V.v_manifest(spark, sf), 20.0, 250.0, closed=True)
    return kept.select("utt_id")


@query("flt3_rejections", covers=("FLT3", "FLT4"),
       sql=f"""{TOKENS}
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(NOT (duration BETWEEN 20.0 AND 1000.0 AND text IS NOT NULL AND text <> '' AND tokens <= 2000)) AS BIGINT) AS rejected,
       CAST(count_if(NOT (duration BETWEEN 20.0 AND 1000.0)) AS BIGINT) AS rejected_duration,
       CAST(count_if(NOT (text IS NOT NULL AND text <> '')) AS BIGINT) AS rejected_text,
       CAST(count_if(NOT (tokens <= 2000)) AS BIGINT) AS rejected_tokens
FROM v_tokens""")
def flt3_rejections(spark, sf):
    t = V.v_tokens(spark, sf)
    return M.rejections(t, {"duration": M.duration_predicate(20.0, 1000.0, closed=True),
                            "text": M.has_text("text"),
                            "tokens": F.col("tokens") <= 2000})


@query("set1_combine", covers=("SET1",),
       sql=f"""{MANIFEST}
SELECT split, count(*) AS rows, count(CASE WHEN split <> 'test' THEN taskname END) AS with_task
FROM v_manifest GROUP BY split""")
def set1_combine(spark, sf):
    m = V.v_manifest(spark, sf)
    parts = [m.filter(F.col("split") == "train"),
             m.filter(F.col("split") == "validate"),
             m.filter(F.col("split") == "test")]
    parts[2] = parts[2].drop("taskname")          # filled with nulls by the union
    return M.combine(parts).groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                                 F.count("taskname").alias("with_task"))


@query("set2_concat", covers=("SET2",),
       sql=f"""{MANIFEST}
SELECT utt_id, CASE WHEN split = 'test' THEN 0 WHEN split = 'train' THEN 1 ELSE 2 END AS source_order FROM v_manifest""")
def set2_concat(spark, sf):
    m = V.v_manifest(spark, sf)
    base = m.filter(F.col("split") == "test").drop("pnc")
    new = [m.filter(F.col("split") == "train"), m.filter(F.col("split") == "validate")]
    return M.concat(base, *new).select("utt_id", F.col("source_order").cast("int"))


@query("set3_corpus", covers=("SET3", "AGG5", "SNK3"),
       sql=f"""SELECT unnest(string_split(t, chr(10))) AS text FROM (
  SELECT DISTINCT t FROM (
    SELECT {V.sql_strip('text')} AS t FROM documents WHERE text IS NOT NULL AND text <> ''
    UNION ALL
    SELECT {V.sql_strip('text')} AS t FROM conversations WHERE text IS NOT NULL AND text <> '')
  WHERE t <> '')""")
def set3_corpus(spark, sf):
    """Distinct texts of two tables written as a line corpus and read back: a text
    holding line breaks becomes several corpus lines, as in any line corpus."""
    docs = V.table(spark, sf, "documents")
    conv = V.table(spark, sf, "conversations")
    out = scratch_path(spark, "corpus")
    K.write_corpus(M.corpus([docs, conv]), out)
    return spark.read.option("lineSep", "\n").text(out).withColumnRenamed("value", "text")


@query("agg4_manifest_counts", covers=("AGG4",),
       sql=f"""{MANIFEST}
SELECT split, dataset, count(*) AS rows FROM v_manifest GROUP BY ROLLUP (split, dataset)""")
def agg4_manifest_counts(spark, sf):
    return M.manifest_counts(V.v_manifest(spark, sf))


@query("agg5_distinct_texts", covers=("AGG5",),
       sql=f"""{MANIFEST}
SELECT source_lang AS lang, count(DISTINCT {V.sql_strip('text')}) AS distinct_texts,
       count(*) AS rows FROM v_manifest GROUP BY source_lang""")
def agg5_distinct_texts(spark, sf):
    return M.distinct_texts(V.v_manifest(spark, sf).withColumnRenamed("source_lang", "lang"), ["lang"])


@query("agg6_corpus_stats", covers=("AGG6", "SRC1", "SCL14"),
       sql=f"""WITH t AS (
  SELECT text FROM documents UNION ALL SELECT text FROM conversations),
b AS (SELECT count(*) AS n FROM benchmark)
SELECT CAST(count_if(text IS NOT NULL AND text <> '') AS BIGINT) AS processed,
       CAST(count(DISTINCT CASE WHEN text IS NOT NULL AND text <> '' THEN {V.sql_strip('text')} END) AS BIGINT) AS "unique",
       CAST(count_if(text IS NOT NULL AND text <> '') - count(DISTINCT CASE WHEN text IS NOT NULL AND text <> '' THEN {V.sql_strip('text')} END) AS BIGINT) AS duplicates,
       CAST(count_if(text IS NULL OR text = '') + (SELECT n FROM b) AS BIGINT) AS errors,
       7 AS files, round(100.0 * (processed - "unique") / processed, 6) AS dedup_rate
FROM t""")
def agg6_corpus_stats(spark, sf):
    """Seven manifests, three of each table and one of bad lines, each a folder that all tasks write parts of."""
    root = scratch_path(spark, "agg6")
    for name in ("documents", "conversations"):
        K.write_manifest(K.dealt(V.table(spark, sf, name).select("text"), 3), f"{root}/{name}", partition_by=("manifest",))
    _bad_lines(spark, sf).write.text(f"{root}/bad")
    lines = S.read_manifest_lines(spark, f"{root}/documents,{root}/conversations,{root}/bad", folders=True)
    return M.corpus_stats(lines).select("processed", "unique", "duplicates", "errors", F.col("files").cast("int").alias("files"),
                                        F.round("dedup_rate", 6).alias("dedup_rate"))


@query("agg7_duration_summary", covers=("AGG7", "FLT1"),
       sql=f"""{MANIFEST}
SELECT split, CAST(count_if(duration >= 20.0 AND duration < 250.0) AS BIGINT) AS kept_rows,
       sum(CASE WHEN duration >= 20.0 AND duration < 250.0 THEN duration END) AS kept_seconds,
       CAST(count_if(NOT (duration >= 20.0 AND duration < 250.0)) AS BIGINT) AS filtered_rows,
       sum(CASE WHEN NOT (duration >= 20.0 AND duration < 250.0) THEN duration END) AS filtered_seconds
FROM v_manifest GROUP BY split""")
def agg7_duration_summary(spark, sf):
    return M.duration_summary(V.v_manifest(spark, sf), 20.0, 250.0, by=["split"])


@query("snk2_combined_manifest", covers=("SNK2", "SET1", "SRC2"),
       sql=f"""{MANIFEST}
SELECT split, dataset, count(*) AS rows FROM v_manifest GROUP BY split, dataset""")
def snk2_combined_manifest(spark, sf):
    """Per-dataset manifests scanned and written back as one combined manifest per
    split (union all, duplicates kept), then read from the combined folders."""
    root = scratch_path(spark, "datasets")
    K.write_manifest(V.v_manifest(spark, sf), root, partition_by=("dataset", "split"))
    combined = scratch_path(spark, "combined")
    K.write_manifest(S.scan_manifests(spark, root).select(*MCOLS), combined, partition_by=("split",))
    back = S.read_manifest(spark, combined)
    return back.groupBy("split", "dataset").agg(F.count(F.lit(1)).alias("rows"))


@query("prj12_field_mapping", covers=("PRJ12", "SRC1"),
       sql=f"""{MANIFEST}
SELECT utt_id, text, source_lang AS lang, duration FROM v_manifest""")
def prj12_field_mapping(spark, sf):
    """A manifest whose text and language live under other keys, read with
    ``text_field`` / ``lang_field``."""
    m = V.v_manifest(spark, sf).select("utt_id", "audio_filepath", "duration",
                                       F.col("text").alias("sentence"),
                                       F.col("source_lang").alias("language"))
    path = scratch_path(spark, "prj12")
    K.write_manifest(m, path, partition_by=())
    df = S.read_manifest(spark, path, text_field="sentence", lang_field="language")
    return df.select("utt_id", "text", "lang", "duration")
