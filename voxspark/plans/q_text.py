"""Queries: transcript text functions and word error rate (SCL1-13, JOIN3, AGG1-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import wer as W
from . import views as V
from .registry import query, r6

MANIFEST = V.with_views("v_manifest")


def _clean_chars_sql(e: str) -> str:
    for a, b in X.CLEAN_REPLACEMENTS:
        e = f"replace({e}, {V.sql_lit(a)}, {V.sql_lit(b)})"
    return e

PAIRS = V.with_views("v_pairs")


@query("scl8_clean_text", covers=("SCL1", "SCL2", "SCL3", "SCL4", "SCL5", "SCL6", "SCL7", "SCL8"),
       sql=f"""{MANIFEST}
SELECT utt_id, {V.sql_clean_text('text')} AS clean FROM v_manifest""")
def scl8_clean_text(spark, sf):
    m = V.v_manifest(spark, sf)
    return m.select("utt_id", X.clean_text("text").alias("clean"))


@query("scl1_clean_steps", covers=("SCL1", "SCL2", "SCL3", "SCL6"),
       sql=f"""{MANIFEST}
SELECT lang, CAST(sum(length(text) - length(c1)) AS BIGINT) AS removed_chars,
       CAST(count_if(c1 <> s2) AS BIGINT) AS stripped_rows,
       CAST(count_if(position('…' IN text) > 0) AS BIGINT) AS ellipsis_rows,
       CAST(count_if(regexp_matches(text, '"{{2,}}')) AS BIGINT) AS quote_run_rows
FROM (SELECT source_lang AS lang, text, c1, {V.sql_strip('c1')} AS s2
      FROM (SELECT *, {_clean_chars_sql('text')} AS c1 FROM v_manifest))
GROUP BY lang""")
def scl1_clean_steps(spark, sf):
    m = V.v_manifest(spark, sf).select(F.col("source_lang").alias("lang"), "text")
    m = m.withColumn("c1", X.clean_chars("text")).withColumn("s2", X.py_strip("c1"))
    return m.groupBy("lang").agg(
        F.sum(F.length("text") - F.length("c1")).cast("long").alias("removed_chars"),
        F.count_if(F.col("c1") != F.col("s2")).alias("stripped_rows"),
        F.count_if(F.col("text").contains("…")).alias("ellipsis_rows"),
        F.count_if(F.col("text").rlike('"{2,}')).alias("quote_run_rows"))


@query("scl10_no_punct", covers=("SCL9", "SCL10", "SCL11"),
       sql=f"""{MANIFEST}
SELECT utt_id, np, CAST(len({V.sql_words('np')}) AS INTEGER) AS n_words
FROM (SELECT utt_id, {V.sql_no_punct('text')} AS np FROM v_manifest)""")
def scl10_no_punct(spark, sf):
    m = V.v_manifest(spark, sf).select("utt_id", X.no_punct("text").alias("np"))
    return m.select("utt_id", "np", F.size(X.words("np")).cast("int").alias("n_words"))


@query("join3_pairs", covers=("JOIN3",),
       sql=f"""{PAIRS}
SELECT p.utt_id, m.split, m.source_lang AS lang,
       CAST(len({V.sql_words('p.prediction')}) AS INTEGER) AS hyp_words,
       CAST(len({V.sql_words(V.sql_no_punct('m.text'))}) AS INTEGER) AS ref_words
FROM v_pairs p JOIN v_manifest m ON p.utt_id = m.utt_id""")
def join3_pairs(spark, sf):
    preds = V.v_pairs(spark, sf).select("utt_id", "prediction")
    refs = V.v_manifest(spark, sf).select("utt_id", "split", F.col("source_lang").alias("lang"),
                                          F.col("text").alias("reference"))
    p = W.pair(preds, refs)
    return p.select("utt_id", "split", "lang",
                    F.size(X.words("prediction")).cast("int").alias("hyp_words"),
                    F.size(X.words(X.no_punct("reference"))).cast("int").alias("ref_words"))


@query("join3_by_position", covers=("JOIN3",),
       sql=f"""{PAIRS},
h AS (SELECT prediction, row_number() OVER (ORDER BY utt_id) - 1 AS position FROM v_pairs WHERE split <> 'test'),
r AS (SELECT utt_id, text, row_number() OVER (ORDER BY utt_id) - 1 AS position FROM v_manifest)
SELECT position, utt_id AS reference_id, CAST(len({V.sql_words('prediction')}) AS INTEGER) AS hyp_words,
       CAST(len({V.sql_words(V.sql_no_punct('text'))}) AS INTEGER) AS ref_words
FROM h JOIN r USING (position)""")
def join3_by_position(spark, sf):
    """Hypotheses of fewer rows than references, paired by their places in two files."""
    preds = V.v_pairs(spark, sf).where("split <> 'test'").select("utt_id", "prediction")
    refs = V.v_manifest(spark, sf).select(F.col("utt_id").alias("reference_id"), F.col("text").alias("reference"))
    p = W.pair_by_position(preds, refs, ["utt_id"], ["reference_id"])
    return p.select("position", "reference_id", F.size(X.words("prediction")).cast("int").alias("hyp_words"),
                    F.size(X.words(X.no_punct("reference"))).cast("int").alias("ref_words"))


def _wer_by_lang(spark, sf):
    pairs = V.v_pairs(spark, sf)
    w = W.wer(W.score_pairs(pairs), by=["lang"])
    return w.select("lang", "edits", "words", "rows", r6("wer").alias("wer"))


# Word-level Levenshtein on whole texts has no DuckDB form (its levenshtein counts
# bytes); checked against a plain DP in tests/test_wer.py instead.
query("agg1_wer", covers=("AGG1", "SCL12"))(_wer_by_lang)


@query("agg2_wer_merged", covers=("AGG2",))
def agg2_wer_merged(spark, sf):
    """Per-split partial states merged into one corpus value (the all-gather replaced
    by a shuffle aggregate)."""
    part = W.wer(W.score_pairs(V.v_pairs(spark, sf)), by=["split"])
    tot = part.agg(F.sum("edits").cast("long").alias("edits"),
                   F.sum("words").cast("long").alias("words"),
                   F.sum("rows").cast("long").alias("rows"))
    return tot.withColumn("wer", r6(W.wer_value(F.col("edits"), F.col("words"))))


WER_SQL = "CASE WHEN sum(words) = 0 THEN CAST('inf' AS DOUBLE) ELSE round(sum(edits) / sum(words), 6) END"
SUMS = f"CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(words) AS BIGINT) AS words, count(*) AS rows, {WER_SQL} AS wer"


@query("agg1_wer_turns", covers=("AGG1", "SCL12"),
       sql=f"{V.sql_turn_edits()} SELECT role, {SUMS} FROM scored WHERE kind = 'np' GROUP BY role")
def agg1_wer_turns(spark, sf):
    out = W.wer(W.score_pairs(V.v_turn_pairs(spark, sf)), by=["role"])
    return out.withColumn("wer", r6("wer"))


@query("agg2_wer_merged_turns", covers=("AGG2",),
       sql=f"{V.sql_turn_edits()} SELECT {SUMS} FROM scored WHERE kind = 'np'")
def agg2_wer_merged_turns(spark, sf):
    part = W.wer(W.score_pairs(V.v_turn_pairs(spark, sf)), by=["role"])
    tot = part.agg(*[F.sum(c).cast("long").alias(c) for c in ("edits", "words", "rows")])
    return tot.withColumn("wer", r6(W.wer_value(F.col("edits"), F.col("words"))))


@query("agg3_quality_report_turns", covers=("AGG3", "SCL12", "SCL13"),
       sql=f"""{V.sql_turn_edits()},
w AS (SELECT role, kind, count(*) AS samples,
             CASE WHEN sum(words) = 0 THEN CAST('inf' AS DOUBLE) ELSE sum(edits) / sum(words) END AS wer FROM scored GROUP BY role, kind)
SELECT a.role, a.samples, round(a.wer, 6) AS wer, round(b.wer, 6) AS wer_no_punct,
       CASE WHEN isinf(b.wer) THEN 'inf' WHEN b.wer > 1.0 THEN 'critical' WHEN b.wer > 0.5 THEN 'very high'
            WHEN b.wer > 0.3 THEN 'high' WHEN b.wer > 0.15 THEN 'medium' ELSE 'low' END AS band,
       CASE WHEN isinf(b.wer) THEN 'inf' ELSE printf('%.4f (%.1f%%)', b.wer, b.wer * 100) END AS wer_no_punct_text
FROM w a JOIN w b ON a.role IS NOT DISTINCT FROM b.role AND a.kind = 'raw' AND b.kind = 'np'""")
def agg3_quality_report_turns(spark, sf):
    rep = W.quality_report(V.v_turn_pairs(spark, sf), by=["role"])
    return rep.select("role", "samples", r6("wer").alias("wer"), r6("wer_no_punct").alias("wer_no_punct"),
                      "band", "wer_no_punct_text")


@query("agg3_quality_report", covers=("AGG3", "SCL13"))
def agg3_quality_report(spark, sf):
    rep = W.quality_report(V.v_pairs(spark, sf), by=["split"])
    return rep.select("split", "samples", r6("wer").alias("wer"),
                      r6("wer_no_punct").alias("wer_no_punct"), "band", "wer_no_punct_text")


@query("scl13_wer_band", covers=("SCL13",),
       sql=f"""{PAIRS}
SELECT utt_id, CASE WHEN w = 0 THEN 'inf' WHEN r > 1.0 THEN 'critical' WHEN r > 0.5 THEN 'very high'
       WHEN r > 0.3 THEN 'high' WHEN r > 0.15 THEN 'medium' ELSE 'low' END AS band
FROM (SELECT utt_id, len({V.sql_words(V.sql_no_punct('prediction'))}) AS h,
             len({V.sql_words(V.sql_no_punct('reference'))}) AS w,
             abs(len({V.sql_words(V.sql_no_punct('prediction'))}) - len({V.sql_words(V.sql_no_punct('reference'))}))
               / greatest(len({V.sql_words(V.sql_no_punct('reference'))}), 1) AS r
      FROM v_pairs)""")
def scl13_wer_band(spark, sf):
    """Band of the length-difference ratio per utterance (a lower bound of its WER),
    which SQL can check; inf when the reference is empty."""
    p = V.v_pairs(spark, sf)
    # columns of their own: the band's branches would each normalise the texts anew
    p = p.select("utt_id", F.size(X.words(X.no_punct("prediction"))).alias("h"), F.size(X.words(X.no_punct("reference"))).alias("w"))
    h, w = F.col("h"), F.col("w")
    r = F.when(w == 0, F.lit(float("inf"))).otherwise(
        F.abs(h - w).cast("double") / F.greatest(w, F.lit(1)))
    return p.withColumn("r", r).select("utt_id", X.wer_band("r").alias("band"))
