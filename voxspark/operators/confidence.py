"""Confidence evaluation (AGG14-AGG20, JOIN7, JOIN8, SNK7).

Inputs are scored units ``(group..., score, correct)``.  Every metric reduces to sums
over a per-group histogram of distinct scores (bounded by the number of distinct scores,
not by rows), so the row-level work is one partial aggregate.  Grid points become a
group key: the four word aggregations are computed in one ``groupBy`` and unpivoted,
never by joining the data to the grid.

Pinned formulas (the reference names the metrics only):
* auc_roc: Mann-Whitney with mid-ranks, positive class = correct;
* auc_pr: average precision sum_k (R_k - R_{k-1}) P_k over distinct thresholds, descending;
* auc_nt: auc_pr with label and score inverted;
* nce: (H(p) - CE) / H(p), scores clipped to [1e-15, 1 - 1e-15]; null when H(p) = 0;
* ece: sum_b n_b/n |acc_b - conf_b| over 100 equal-width bins;
* auc_yc / std_yc / max_yc: mean, population std and max of TPR - FPR at thresholds
  0/100 ... 100/100.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.naming import experiment_name
from ..session import written
from .index import running_sums

# Fixed values.
EPS = 1e-15
ECE_BINS = 100
YC_STEPS = 100
REPORT_COLUMNS = ["model_type", "aggregation", "blank", "duration", "method_name",
                  "entropy_type", "entropy_norm", "alpha", "target_level", "auc_roc", "auc_pr",
                  "auc_nt", "nce", "ece", "auc_yc", "std_yc", "max_yc"]
AGGREGATIONS = ["min", "prod", "mean", "max"]


def word_confidence(tokens: DataFrame, keys: list[str], score: str = "score",
                    correct: str = "correct") -> DataFrame:
    """AGG14: token -> word confidence for all aggregations at once, unpivoted to
    ``(keys..., aggregation, score, correct)``; a word is correct when all its tokens
    are.  ``prod`` is exp(sum(ln p)), 0 when any token scores 0."""
    s = F.col(score)
    w = tokens.groupBy(*keys).agg(
        F.min(s).alias("min"), F.max(s).alias("max"), F.avg(s).alias("mean"),
        F.sum(F.log(F.when(s > 0, s))).alias("_lnsum"),
        F.min(F.col(correct)).alias(correct))
    w = w.withColumn("prod", F.when(F.col("min") <= 0, F.lit(0.0)).otherwise(F.exp("_lnsum")))
    stack = ", ".join(f"'{a}', `{a}`" for a in AGGREGATIONS)
    return w.select(*keys, correct, F.expr(f"stack({len(AGGREGATIONS)}, {stack}) AS (aggregation, {score})"))


def grid(params: dict[str, list]) -> list[dict]:
    """JOIN7: the cartesian product of parameter lists (a driver-side list of a few
    dicts; it is a configuration, not data)."""
    keys = sorted(params)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[params[k] for k in keys])]


def _same(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, a null key being a key like any other."""
    b = b.withColumnsRenamed({k: f"_r_{k}" for k in by})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in by])
    return a.join(b, on, how).drop(*[f"_r_{k}" for k in by])


def confidence_metrics(df: DataFrame, by: list[str], score: str = "score",
                       correct: str = "correct") -> DataFrame:
    """AGG15-AGG20 per group of ``by`` (a null key is a group).

    The rows are read once, into a histogram ``(group, score) -> (pos, neg)``; every
    metric is derived from that histogram, whose size is bounded by the number of
    distinct scores per group, whatever the row count."""
    y = F.col(correct).cast("long")
    hist = written(df.groupBy(*by, F.col(score).alias("s"))
                   .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")), "scores")
    s = F.col("s")
    cnt = F.col("pos") + F.col("neg")
    clipped = F.least(F.greatest(s, F.lit(EPS)), F.lit(1 - EPS))
    base = hist.groupBy(*by).agg(
        F.sum(cnt).alias("n"), F.sum("pos").alias("P"),
        F.sum(F.col("pos") * F.log(clipped) + F.col("neg") * F.log(1 - clipped)).alias("_lls"))
    p = F.col("P") / F.col("n")
    h = -(p * F.log(p) + (1 - p) * F.log(1 - p))
    base = base.withColumn("nce", F.when((F.col("P") > 0) & (F.col("P") < F.col("n")),
                                         (h + F.col("_lls") / F.col("n")) / h)).drop("_lls")

    # sums up to every score over the whole (group, score) order, less the group's start: a
    # group of many distinct scores is spread over tasks
    run = running_sums(hist, [*by, "s"], {"_cp": "pos", "_cn": "neg"})
    first = run.groupBy(*by).agg(F.min(F.col("_cp") - F.col("pos")).alias("_p0"), F.min(F.col("_cn") - F.col("neg")).alias("_n0"))
    r = _same(run, _same(base.select(*by, "n", "P"), first, by), by)
    below = F.col("_cp") - F.col("pos") - F.col("_p0")
    r = (r.withColumn("neg_below", F.col("_cn") - F.col("neg") - F.col("_n0"))
          .withColumn("tp", F.col("P") - below)
          .withColumn("fp", F.col("n") - F.col("P") - F.col("neg_below"))
          .withColumn("tn_inv", F.col("neg_below") + F.col("neg"))
          .withColumn("fn_inv", below + F.col("pos")))
    ranks = r.groupBy(*by).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("_mw"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_ap"),
        # inverted: class = incorrect, score = 1 - s, so thresholds run over s ascending
        F.sum(F.col("neg") * F.col("tn_inv") / (F.col("tn_inv") + F.col("fn_inv"))).alias("_nt"))

    # calibration: 100 equal bins
    b = F.least(F.floor(s * ECE_BINS), F.lit(ECE_BINS - 1)).cast("int")
    cal = hist.groupBy(*by, b.alias("_b")).agg(
        F.sum(cnt).alias("_nb"), F.sum("pos").alias("_pb"), F.sum(s * cnt).alias("_sb"))
    ece = cal.groupBy(*by).agg(F.sum(F.abs(F.col("_pb") - F.col("_sb"))).alias("_ece"))

    # Youden curve: counts per threshold step, dense 0..100 per group via a generated
    # sequence joined on (group, step) - an equi join, no cartesian product
    step = F.least(F.floor(s * YC_STEPS), F.lit(YC_STEPS)).cast("int")
    yh = hist.groupBy(*by, step.alias("t")).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    dense = base.select(*by, F.explode(F.sequence(F.lit(0), F.lit(YC_STEPS))).alias("t"))
    yd = _same(dense, yh, [*by, "t"], "left").fillna(0, subset=["_p", "_q"])
    # 101 rows a group
    top = Window.partitionBy(*by).orderBy(F.col("t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    yd = yd.withColumn("_tp", F.sum("_p").over(top)).withColumn("_fp", F.sum("_q").over(top))
    yd = _same(yd, base.select(*by, "n", "P"), by)
    j = F.try_divide(F.col("_tp"), F.col("P")) - F.try_divide(F.col("_fp"), F.col("n") - F.col("P"))
    yc = yd.withColumn("_j", j).groupBy(*by).agg(
        F.avg("_j").alias("auc_yc"), F.stddev_pop("_j").alias("std_yc"), F.max("_j").alias("max_yc"))

    out = _same(_same(_same(base, ranks, by), ece, by), yc, by)
    neg = F.col("n") - F.col("P")
    return out.select(
        *by, "n",
        # single-class groups have no ranking metrics (null, not an error under ANSI)
        F.try_divide(F.col("_mw"), F.col("P") * neg).alias("auc_roc"),
        F.try_divide(F.col("_ap"), F.col("P")).alias("auc_pr"),
        F.try_divide(F.col("_nt"), neg).alias("auc_nt"),
        "nce", F.try_divide(F.col("_ece"), F.col("n")).alias("ece"), "auc_yc", "std_yc", "max_yc")


def evaluate_grid(tokens: DataFrame, word_keys: list[str], score: str = "score",
                  correct: str = "correct", extra_by: list[str] | None = None,
                  params: dict[str, list] | None = None, blank: bool = False, duration: bool = False,
                  method: str = "max_prob", alpha: float = 0.33) -> DataFrame:
    """JOIN7 + JOIN8: every grid point of ``params`` (lists of ``aggregation`` and
    ``target_level``; another axis is an error) over the whole data set in one job.  The grid is
    a short driver list; each point becomes a group key of the unpivoted units, never a join
    with the data.  Token level does not depend on the aggregation (it is reported as '-').
    ``blank``, ``duration``, ``method`` and ``alpha`` say how the scores were made."""
    by = extra_by or []
    params = params or {"aggregation": AGGREGATIONS, "target_level": ["token", "word"]}
    if set(params) != {"aggregation", "target_level"}:
        raise ValueError(f"the grid has the axes aggregation and target_level, not {sorted(params)}")
    points = grid(params)
    word_aggs = sorted({p["aggregation"] for p in points if p["target_level"] == "word"},
                       key=AGGREGATIONS.index)
    # read by both levels: keep it instead of recomputing the text pipeline twice
    tokens = tokens.persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    if any(p["target_level"] == "token" for p in points):
        parts.append(tokens.select(*by, score, correct).withColumn("aggregation", F.lit("-"))
                     .withColumn("target_level", F.lit("token")))
    if word_aggs:
        words = word_confidence(tokens, word_keys + [k for k in by if k not in word_keys], score, correct)
        parts.append(words.filter(F.col("aggregation").isin(word_aggs))
                     .select(*by, score, correct, "aggregation").withColumn("target_level", F.lit("word")))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    m = confidence_metrics(both, [*by, "aggregation", "target_level"], score, correct)
    return m.withColumn("experiment", experiment_name(
        F.col("aggregation"), F.lit(blank), F.lit(duration), F.lit(method), F.lit(alpha)))


def report(metrics: DataFrame, model_type: str = "CTC", method: str = "max_prob",
           alpha: float = 0.33, blank: bool = False, duration: bool = False,
           entropy_type: str = "-", entropy_norm: str = "-") -> DataFrame:
    """SNK7: the 17 report columns (entropy fields '-' for non-entropy methods)."""
    return metrics.select(
        F.lit(model_type).alias("model_type"), F.col("aggregation"),
        F.lit(str(blank)).alias("blank"), F.lit(str(duration)).alias("duration"),
        F.lit(method).alias("method_name"), F.lit(entropy_type).alias("entropy_type"),
        F.lit(entropy_norm).alias("entropy_norm"), F.lit(str(alpha)).alias("alpha"),
        "target_level", "auc_roc", "auc_pr", "auc_nt", "nce", "ece", "auc_yc", "std_yc", "max_yc")


def write_report(df: DataFrame, path: str) -> str:
    """SNK7: CSV with header."""
    df.select(*REPORT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
    return path
