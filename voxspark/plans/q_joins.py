"""Queries: subset joins, custom fields, export rows, audio existence and bytes, tar
shards, prompt slots, single-supervision check (JOIN1, JOIN2, JOIN4, JOIN5, PRJ10, PRJ11,
SRC9, SNK5, SCL18, FLT5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import naming as N
from ..operators import joins as J
from ..operators import manifest as M
from ..operators import shards as H
from ..session import scratch_path
from ..sinks import build as BD
from ..sinks import shards as KS
from ..sinks import tar as T
from ..sources import shards as SS
from . import views as V
from .registry import query

MK = V.with_views("v_manifest", "v_keep")


def _left_custom():
    return F.create_map(F.lit("source"), F.col("dataset"), F.lit("quality"), F.lit("unknown"))


@query("join1_subset", covers=("JOIN1",),
       sql=f"""{MK}
SELECT utt_id, split FROM v_manifest WHERE utt_id IN (SELECT utt_id FROM v_keep)""")
def join1_subset(spark, sf):
    return J.subset(V.v_manifest(spark, sf), V.v_keep(spark, sf)).select("utt_id", "split")


KEEP2 = f"""{MK},
k2 AS (SELECT utt_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic, 1 AS version FROM v_keep
       UNION ALL SELECT utt_id, 'relabelled', CAST(toxic AS VARCHAR), 2 FROM v_keep WHERE toxic = 1),
last AS (SELECT utt_id, max_by(quality, version) AS quality, max_by(toxic, version) AS toxic FROM k2 GROUP BY utt_id)"""


def _keep2(spark, sf):
    k = V.v_keep(spark, sf).withColumn("version", F.lit(1))
    relabel = (k.filter(F.col("custom")["toxic"] == "1")
               .withColumn("custom", F.map_concat(F.create_map(F.lit("quality"), F.lit("relabelled")),
                                                  F.map_filter("custom", lambda kk, v: kk != "quality")))
               .withColumn("version", F.lit(2)))
    return k.unionByName(relabel)


@query("join2_attach_custom", covers=("JOIN2", "WIN6"),
       sql=f"""{KEEP2}
SELECT m.utt_id, m.dataset AS source, l.quality, l.toxic, 3 AS n_keys
FROM v_manifest m JOIN last l ON l.utt_id = m.utt_id""")
def join2_attach_custom(spark, sf):
    m = V.v_manifest(spark, sf).withColumn("custom", _left_custom())
    a = J.attach_custom(m, _keep2(spark, sf), order="version")
    return a.select("utt_id", F.col("custom")["source"].alias("source"),
                    F.col("custom")["quality"].alias("quality"), F.col("custom")["toxic"].alias("toxic"),
                    F.size("custom").alias("n_keys"))


@query("prj10_export_rows", covers=("PRJ10", "PRJ11", "WIN3"),
       sql=f"""{KEEP2}
SELECT m.utt_id || '.flac' AS audio_filepath, m.duration, m.source_lang AS lang, l.quality, l.toxic,
       CAST((row_number() OVER (ORDER BY m.doc_id) - 1) // 25 AS INTEGER) AS shard_id,
       length(m.text) > 0 AS has_text
FROM v_manifest m JOIN last l ON l.utt_id = m.utt_id""")
def prj10_export_rows(spark, sf):
    m = V.v_manifest(spark, sf, keep_doc_id=True).withColumn("custom", _left_custom()) \
        .withColumnRenamed("source_lang", "lang")
    m = m.withColumn("custom", F.map_concat("custom", F.create_map(
        F.lit("dataloading_info"), F.lit("x"), F.lit("shard_id"), F.lit("9"), F.lit("nothing"),
        F.lit(None).cast("string"))))
    a = J.attach_custom(m, _keep2(spark, sf), order="version")
    e = H.shard_fixed(M.export_rows(a), 25, ["doc_id"])
    parsed = F.from_json("export", "map<string,string>")
    return e.select(parsed["audio_filepath"].alias("audio_filepath"),
                    parsed["duration"].cast("double").alias("duration"), parsed["lang"].alias("lang"),
                    parsed["quality"].alias("quality"), parsed["toxic"].alias("toxic"), "shard_id",
                    F.map_contains_key(parsed, F.lit("text")).alias("has_text"))


@query("join4_missing_audio", covers=("JOIN4", "PRJ7"),
       sql=f"""{V.with_views('v_manifest')}
SELECT utt_id, audio_filepath FROM v_manifest WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def join4_missing_audio(spark, sf):
    files = V.v_audio(spark, sf).select("path")
    return J.missing_audio(V.v_manifest(spark, sf), files).select("utt_id", "audio_filepath")


@query("join5_with_audio", covers=("JOIN5", "PRJ3"),
       sql=f"""{V.with_views('v_manifest')}
SELECT utt_id, CAST(44 + 2 * (duration * 16) AS BIGINT) AS bytes, duration AS wav_seconds
FROM v_manifest WHERE doc_id IN (SELECT doc_id FROM labels)""")
def join5_with_audio(spark, sf):
    a = J.with_audio(V.v_manifest(spark, sf), V.v_audio(spark, sf))
    return a.select("utt_id", F.length("content").cast("long").alias("bytes"),
                    M.wav_duration(F.col("content")).alias("wav_seconds"))


@query("snk5_tar_shards", covers=("SNK5", "SRC9", "PRJ8", "WIN1"),
       sql=f"""{V.with_views('v_manifest')},
a AS (SELECT *, row_number() OVER (ORDER BY md5('42' || utt_id), utt_id) - 1 AS idx
      FROM v_manifest WHERE doc_id IN (SELECT doc_id FROM labels)),
k AS (SELECT count(*) // 5 AS k FROM a)
SELECT CAST(idx // k AS INTEGER) AS shard_id,
       replace(replace(regexp_replace(audio_filepath, '\\.wav$', ''), '/', '_'), '.', '_') || '.wav' AS member,
       CAST(44 + 2 * (duration * 16) AS BIGINT) AS size
FROM a, k WHERE idx < k * 5""")
def snk5_tar_shards(spark, sf):
    """Rows with audio, planned over their keys; the bytes join the plan on their way to the tars."""
    files = V.v_audio(spark, sf)
    have = V.v_manifest(spark, sf).join(files.select(F.col("path").alias("audio_filepath")), "audio_filepath", "left_semi")
    cfg = KS.config(num_shards=5, shuffle=True, shuffle_seed=42, sort_in_shards=False)
    plan, _, _ = BD.plan_shards(have, cfg)
    path = scratch_path(spark, "tars")
    T.write_tar_shards(J.with_audio(plan, files), path)
    return SS.read_shards(spark, path).select("shard_id", "member", "size")


@query("scl18_prompt_slots", covers=("SCL18",),
       sql=f"""{V.with_views('v_manifest')}
SELECT utt_id, '<|' || source_lang || '|>' AS source_lang, '<|' || target_lang || '|>' AS target_lang,
       '<|pnc|>' AS pnc, '<|noitn|>' AS itn, '<|emo:undefined|>' AS emotion, 8 AS n_slots
FROM v_manifest""")
def scl18_prompt_slots(spark, sf):
    m = V.v_manifest(spark, sf)
    row = F.create_map(F.lit("source_lang"), F.concat(F.lit("<|"), "source_lang", F.lit("|>")),
                       F.lit("target_lang"), F.concat(F.lit("<|"), "target_lang", F.lit("|>")),
                       F.lit("itn"), F.lit(None).cast("string"))
    s = m.select("utt_id", N.prompt_slots(row).alias("s"))
    return s.select("utt_id", *[F.col("s")[k].alias(k) for k in
                                ("source_lang", "target_lang", "pnc", "itn", "emotion")],
                    F.size("s").alias("n_slots"))


@query("flt5_single_supervision", covers=("FLT5",),
       sql=f"""{V.with_views('v_manifest')}
SELECT utt_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS supervisions FROM v_manifest
WHERE len(string_split(text, chr(10))) <> 1""")
def flt5_single_supervision(spark, sf):
    """Cuts whose supervisions are the text's lines: those without exactly one line
    violate the single-supervision export rule."""
    m = V.v_manifest(spark, sf)
    cuts = m.select("utt_id", F.transform(F.split("text", "\n"), lambda t: F.struct(
        t.alias("text"), F.col("source_lang").alias("language"))).alias("supervisions"))
    bad = J.single_supervision_violations(cuts)
    return bad.select("utt_id", F.size("supervisions").alias("supervisions"))
