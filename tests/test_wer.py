"""Corpus WER on whole texts against a plain DP (AGG1, AGG3, JOIN3)."""
import random
import string
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from brute import edit_distance
from conftest import SF
from voxspark.functions import text as X
from voxspark.operators import wer as W
from voxspark.plans import views as V

PUNCT = string.punctuation + "—–…«»„\"'"


def _norm(t):
    t = unicodedata.normalize("NFKC", t or "")
    t = t.translate(str.maketrans("", "", PUNCT)).lower()
    return " ".join(t.split())


def test_wer_by_lang_matches_plain_dp(spark):
    pairs = V.v_pairs(spark, SF)
    got = {r.lang: (r.edits, r.words, r.rows) for r in W.wer(W.score_pairs(pairs), ["lang"]).collect()}
    exp = {}
    for r in pairs.collect():
        p, ref = _norm(r.prediction).split(), _norm(r.reference).split()
        e, w, n = exp.get(r.lang, (0, 0, 0))
        exp[r.lang] = (e + edit_distance(p, ref), w + len(ref), n + 1)
    assert got == exp


def test_wer_inf_without_words(spark):
    df = spark.createDataFrame([("1", "a b", "")], "utt_id string, prediction string, reference string")
    w = W.wer(W.score_pairs(df)).collect()[0]
    assert w.words == 0 and w.wer == float("inf")


def test_quality_report_has_both_rates(spark):
    rep = W.quality_report(V.v_pairs(spark, SF), ["split"]).collect()
    assert {r.split for r in rep} == {"train", "test", "validate"}
    assert all(r.wer >= 0 and r.wer_no_punct >= 0 for r in rep)


def test_both_rates_take_their_distances_in_one_python_pass(spark):
    """Each further pass is a further worker per core that holds its batches."""
    pairs = spark.createDataFrame([("1", "a b", "a, c")], "utt_id string, prediction string, reference string")
    rep = W.quality_report(pairs)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("ArrowEvalPython") == 2        # NFKC, distances
    r = rep.first()
    assert (r.samples, r.wer, r.wer_no_punct) == (1, 1.0, 0.5)


def test_band_normalises_each_text_once(spark):
    from voxspark.plans.q_text import scl13_wer_band
    plan = scl13_wer_band(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan                        # a filter's argument is not compiled
    assert plan.count("transform(") == 1                # the prediction is made once
    assert plan.count("lower(") == 3                    # text, its prediction, the prediction


def test_pairs_side_by_side_keep_their_own_distances(monkeypatch):
    """Pairs of any lengths, empty ones and carries at each lane's end; also where few fit at once."""
    r = random.Random(4)
    sides = [[r.randrange(v) for _ in range(n)] for v in (1, 2, 9) for n in (0, 1, 7, 8, 9, 15, 16, 17, 63, 64, 65, 90)]
    pairs = [(x, y) for x in sides for y in sides]
    r.shuffle(pairs)
    want = [edit_distance(x, y) for x, y in pairs]
    for lanes in (X.LANES, 5000):
        monkeypatch.setattr(X, "LANES", lanes)
        assert X._edits(pairs) == want


def test_words_are_split_without_squeezing_first(spark):
    texts = ["\u00a0A,  b\t\u2028c. ", "", None, " . ", "\x1cx\x85y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", X.no_punct_words("t").alias("w"), X.words(X.no_punct("t")).alias("v"), X.raw_words("t").alias("r"))
    for x in df.collect():
        assert x.w == x.v == _norm(x.t).split() and x.r == (x.t or "").split()
    assert "trim(" not in df.select("w", "r")._jdf.queryExecution().optimizedPlan().toString()


def test_scoring_holds_texts_and_takes_them_by_slices(spark, monkeypatch):
    """Arrays of words weigh three times their text in the rows that wait for a batch and in the batch."""
    texts = [("a, b", "A b c"), (None, "x"), ("\x1cx\x85y  ", "x, Y"), ("", None), ("ﬁn ½", "fin 1⁄2"), ("w " * 3000, "v " * 10)]
    pairs = spark.createDataFrame([(str(k), p, r) for k, (p, r) in enumerate(texts)], "utt_id string, prediction string, reference string")
    both = W._scored(pairs, "prediction", "reference", {"_raw": F.col, "": X.bare})
    assert "split(" not in both._jdf.queryExecution().executedPlan().toString()
    for r in both.collect():
        raw, bare = ([f(t).split() for t in (r.prediction, r.reference)] for f in (lambda t: t or "", _norm))
        assert (r.edits_raw, r.ref_words_raw) == (edit_distance(*raw), len(raw[1]))
        assert (r.edits, r.ref_words) == (edit_distance(*bare), len(bare[1]))
    batch = [pa.array([t[k] for t in texts] * 5) for k in (0, 1)]
    whole = X._text_edits.func(*batch), X._nfkc_udf.func(batch[0])
    for size in (1, 7, 5000):
        monkeypatch.setattr(X, "SLICE", size)
        assert sum(n for _, n in X._slices(*batch)) == len(batch[0])
        assert (X._text_edits.func(*batch), X._nfkc_udf.func(batch[0])) == whole
    assert whole[1].to_pylist() == [t and unicodedata.normalize("NFKC", t) for t, _ in texts] * 5
    assert X._nfkc_udf.func(pa.array([], pa.string())).to_pylist() == []


def test_distances_near_the_diagonal_are_whole(monkeypatch):
    """Rows are chosen anew every few columns; texts that share their words in another order pass the first bound."""
    r = random.Random(8)
    pairs = []
    for v in (2, 30, 1000):
        for part in (0.03, 0.2, 0.6):
            x = [r.randrange(v) for _ in range(r.randrange(90, 220))]
            pairs += [(x, [r.randrange(v) if r.random() < part else w for w in x if r.random() > part / 4]), (x[50:] + x[:50], x), (x, x[:7])]
    want = [edit_distance(x, y) for x, y in pairs]
    for steps in (1, 13, X.STEPS):
        monkeypatch.setattr(X, "STEPS", steps)
        assert X._edits(pairs) == want


def test_texts_are_split_at_every_white_space():
    texts = [f"a{c}{c}b{c}" for c in map(chr, range(1, 0x30000)) if not 0xD800 <= ord(c) <= 0xDFFF]
    got = X._text_edits.func(pa.array([""] * len(texts)), pa.array(texts))
    assert got.field("words").to_pylist() == got.field("edits").to_pylist() == [len(t.split()) for t in texts]
