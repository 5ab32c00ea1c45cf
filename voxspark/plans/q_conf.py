"""Queries: word confidence, confidence metrics, grid evaluation, report
(AGG14-AGG20, JOIN7, JOIN8, SCL20, SNK7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import confidence as C
from ..session import scratch_path
from . import views as V
from .registry import query, r6

TS = V.with_views("v_token_scores")
METRICS = ["auc_roc", "auc_pr", "auc_nt", "nce", "ece", "auc_yc", "std_yc", "max_yc"]


def sql_metrics(src: str, by: list[str]) -> str:
    """DuckDB text of the pinned confidence metrics over ``src(by..., score, correct)``."""
    g = ", ".join(by)
    part = f"PARTITION BY {g}"
    clip = "least(greatest(score, 1e-15), 1 - 1e-15)"
    return f"""
base AS (SELECT {g}, count(*) AS n, sum(correct) AS P,
                avg(correct * ln({clip}) + (1 - correct) * ln(1 - {clip})) AS ll
         FROM {src} GROUP BY {g}),
hist AS (SELECT {g}, score, sum(correct) AS pos, sum(1 - correct) AS neg FROM {src} GROUP BY {g}, score),
h2 AS (SELECT *,
         coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
         sum(pos) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
         sum(neg) OVER ({part} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
         sum(neg) OVER ({part} ORDER BY score ROWS UNBOUNDED PRECEDING) AS tn_inv,
         sum(pos) OVER ({part} ORDER BY score ROWS UNBOUNDED PRECEDING) AS fn_inv FROM hist),
ranks AS (SELECT {g}, sum(pos * (neg_below + 0.5 * neg)) AS mw, sum(pos * tp / (tp + fp)) AS ap,
                 sum(neg * tn_inv / (tn_inv + fn_inv)) AS nt FROM h2 GROUP BY {g}),
cal AS (SELECT {g}, least(floor(score * 100), 99) AS b, count(*) AS nb, avg(correct) AS acc,
               avg(score) AS conf FROM {src} GROUP BY {g}, b),
ece AS (SELECT {g}, sum(nb * abs(acc - conf)) AS e FROM cal GROUP BY {g}),
yh AS (SELECT {g}, CAST(least(floor(score * 100), 100) AS INTEGER) AS t, sum(correct) AS p,
              sum(1 - correct) AS q FROM {src} GROUP BY {g}, t),
dense AS (SELECT {g}, CAST(unnest(range(0, 101)) AS INTEGER) AS t FROM base),
yd AS (SELECT dense.*, coalesce(yh.p, 0) AS p, coalesce(yh.q, 0) AS q FROM dense LEFT JOIN yh USING ({g}, t)),
yc1 AS (SELECT {g}, t, sum(p) OVER ({part} ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS ytp,
               sum(q) OVER ({part} ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS yfp FROM yd),
yc AS (SELECT {g}, avg(ytp / P - yfp / (n - P)) AS auc_yc, stddev_pop(ytp / P - yfp / (n - P)) AS std_yc,
              max(ytp / P - yfp / (n - P)) AS max_yc FROM yc1 JOIN base USING ({g}) GROUP BY {g}),
metrics AS (
  SELECT {g}, n, round(mw / (P * (n - P)), 6) AS auc_roc, round(ap / P, 6) AS auc_pr,
         round(nt / (n - P), 6) AS auc_nt,
         round(CASE WHEN P > 0 AND P < n THEN
               (-(P / n * ln(P / n) + (1 - P / n) * ln(1 - P / n)) + ll) / -(P / n * ln(P / n) + (1 - P / n) * ln(1 - P / n))
               END, 6) AS nce,
         round(e / n, 6) AS ece, round(auc_yc, 6) AS auc_yc, round(std_yc, 6) AS std_yc, round(max_yc, 6) AS max_yc
  FROM base JOIN ranks USING ({g}) JOIN ece USING ({g}) JOIN yc USING ({g}))"""


def _round(df, by):
    return df.select(*by, "n", *[r6(m).alias(m) for m in METRICS])


WORDS_SQL = """words AS (
  SELECT utt_id, word_id, lang, min(correct) AS correct, min(score) AS smin, max(score) AS smax,
         avg(score) AS smean, CASE WHEN min(score) <= 0 THEN 0.0 ELSE exp(sum(ln(score))) END AS sprod
  FROM v_token_scores GROUP BY utt_id, word_id, lang)"""


@query("agg14_word_confidence", covers=("AGG14",),
       sql=f"""{TS},
{WORDS_SQL}
SELECT utt_id, word_id, correct, a.aggregation, round(a.score, 6) AS score FROM words,
  (SELECT unnest([{{'aggregation': 'min', 'score': smin}}, {{'aggregation': 'prod', 'score': sprod}},
                  {{'aggregation': 'mean', 'score': smean}}, {{'aggregation': 'max', 'score': smax}}], recursive := true)) a""")
def agg14_word_confidence(spark, sf):
    w = C.word_confidence(V.v_token_scores(spark, sf), ["utt_id", "word_id"])
    return w.select("utt_id", "word_id", "correct", "aggregation", r6("score").alias("score"))


@query("agg15_confidence_metrics", covers=("AGG15", "AGG16", "AGG17", "AGG18", "AGG19", "AGG20"),
       sql=f"""{TS},
{sql_metrics('v_token_scores', ['lang'])}
SELECT * FROM metrics""")
def agg15_confidence_metrics(spark, sf):
    m = C.confidence_metrics(V.v_token_scores(spark, sf), ["lang"])
    return _round(m, ["lang"])


@query("agg18_labelled_scores", covers=("AGG15", "AGG18", "AGG19"),
       sql=f"""{V.with_views('v_scores')},
{sql_metrics('v_scores', ['lang'])}
SELECT * FROM metrics""")
def agg18_labelled_scores(spark, sf):
    """Metrics over the labelled documents (quality as the correctness label)."""
    return _round(C.confidence_metrics(V.v_scores(spark, sf), ["lang"]), ["lang"])


GRID_SRC = f"""{TS},
{WORDS_SQL},
units AS (
  SELECT '-' AS aggregation, 'token' AS target_level, score, correct FROM v_token_scores
  UNION ALL SELECT 'min', 'word', smin, correct FROM words
  UNION ALL SELECT 'prod', 'word', sprod, correct FROM words
  UNION ALL SELECT 'mean', 'word', smean, correct FROM words
  UNION ALL SELECT 'max', 'word', smax, correct FROM words),
{sql_metrics('units', ['aggregation', 'target_level'])}"""


@query("join8_evaluate_grid", covers=("JOIN7", "JOIN8", "SCL20"),
       sql=f"""{GRID_SRC}
SELECT *, aggregation || '-blank-no_duration-max_prob-0.33' AS experiment FROM metrics""")
def join8_evaluate_grid(spark, sf):
    ts = V.v_token_scores(spark, sf)
    m = C.evaluate_grid(ts, ["utt_id", "word_id"],
                        params={"aggregation": ["min", "prod", "mean", "max"],
                                "target_level": ["token", "word"]})
    return m.select("aggregation", "target_level", "n", *[r6(c).alias(c) for c in METRICS],
                    "experiment")


@query("snk7_report", covers=("SNK7",),
       sql=f"""{GRID_SRC}
SELECT 'CTC' AS model_type, aggregation, 'False' AS blank, 'False' AS duration, 'max_prob' AS method_name,
       '-' AS entropy_type, '-' AS entropy_norm, '0.33' AS alpha, target_level,
       auc_roc, auc_pr, auc_nt, nce, ece, auc_yc, std_yc, max_yc FROM metrics""")
def snk7_report(spark, sf):
    m = C.evaluate_grid(V.v_token_scores(spark, sf), ["utt_id", "word_id"])
    path = scratch_path(spark, "report")
    C.write_report(C.report(m), path)
    schema = ", ".join(f"{c} {'double' if c in METRICS else 'string'}" for c in C.REPORT_COLUMNS)
    back = spark.read.option("header", True).schema(schema).csv(path)
    return back.select(*[r6(c).alias(c) if c in METRICS else F.col(c) for c in C.REPORT_COLUMNS])
