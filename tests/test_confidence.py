"""Confidence metrics against direct formulas (AGG15-AGG20)."""
import math
import random

from conftest import SF
from voxspark.operators import confidence as C
from voxspark.plans import views as V


def _brute(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    auc = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg) / (len(pos) * len(neg))
    ths = sorted({s for s, _ in rows}, reverse=True)
    ap = 0.0
    for t in ths:
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        ap += sum(1 for s, y in rows if s == t and y == 1) / len(pos) * tp / (tp + fp)
    js = []
    for k in range(101):
        t = k / 100
        js.append(sum(1 for s in pos if s >= t) / len(pos) - sum(1 for s in neg if s >= t) / len(neg))
    mu = sum(js) / len(js)
    return auc, ap, mu, max(js), math.sqrt(sum((j - mu) ** 2 for j in js) / len(js))


def test_metrics_match_formulas(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1024) / 1024.0, int(rnd.random() < 0.6)) for _ in range(400)]
    df = spark.createDataFrame([("g", s, y) for s, y in rows], "g string, score double, correct int")
    m = C.confidence_metrics(df, ["g"]).collect()[0]
    auc, ap, yc, ymax, ystd = _brute(rows)
    assert abs(m.auc_roc - auc) < 1e-9 and abs(m.auc_pr - ap) < 1e-9
    assert abs(m.auc_yc - yc) < 1e-9 and abs(m.max_yc - ymax) < 1e-9 and abs(m.std_yc - ystd) < 1e-9
    assert 0 <= m.ece <= 1 and m.nce is not None


def test_null_group_and_free_scores(spark):
    rnd = random.Random(6)
    rows = {g: [(rnd.random(), int(rnd.random() < 0.5)) for _ in range(150)] for g in ("a", None)}
    df = spark.createDataFrame([(g, s, y) for g, x in rows.items() for s, y in x], "g string, score double, correct int")
    got = {r.g: r for r in C.confidence_metrics(df, ["g"]).collect()}
    assert set(got) == {"a", None}
    for g, x in rows.items():
        auc, ap, yc, ymax, _ = _brute(x)
        assert got[g].n == 150 and abs(got[g].auc_roc - auc) < 1e-9 and abs(got[g].auc_pr - ap) < 1e-9
        assert abs(got[g].auc_yc - yc) < 1e-9 and abs(got[g].max_yc - ymax) < 1e-9


def test_word_confidence_aggregations(spark):
    df = spark.createDataFrame([("u", 0, 0.5, 1), ("u", 0, 0.25, 1), ("u", 1, 0.0, 0)],
                               "utt_id string, word_id int, score double, correct int")
    got = {(r.word_id, r.aggregation): r.score for r in C.word_confidence(df, ["utt_id", "word_id"]).collect()}
    assert got[(0, "min")] == 0.25 and got[(0, "max")] == 0.5 and abs(got[(0, "prod")] - 0.125) < 1e-12
    assert got[(1, "prod")] == 0.0 and got[(0, "mean")] == 0.375


def test_token_scores_normalise_each_text_once(spark):
    plan = V.v_token_scores(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("ArrowEvalPython") == 1
