"""Word error rate (JOIN3, SCL10-12, AGG1-3).

Corpus WER = sum of word edits / sum of reference words over the group (not a mean of
ratios); +inf when the group has no reference words.  The three sums are ordinary
partial+final aggregates, so a hot group never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .index import with_index


def pair(predictions: DataFrame, references: DataFrame, key: str = "utt_id") -> DataFrame:
    """JOIN3: pair each hypothesis with its reference by utterance id (inner)."""
    return predictions.join(references, key, "inner")


def pair_by_position(predictions: DataFrame, references: DataFrame, order: list[str], reference_order: list[str] | None = None) -> DataFrame:
    """JOIN3 without ids: the k-th hypothesis in ``order`` with the k-th reference in ``reference_order`` (the same
    columns if not given), cut to the shorter side; ``position`` counts from 0.  Both orders must
    be total.  Columns that both sides have are taken from the hypotheses."""
    left = with_index(predictions, order, col="position")
    right = with_index(references, reference_order or order, col="position")
    return left.join(right.drop(*[c for c in right.columns if c in predictions.columns and c != "position"]), "position", "inner")


def score_pairs(df: DataFrame, pred: str = "prediction", ref: str = "reference",
                punctuation: bool = False) -> DataFrame:
    """Add ``ref_words`` and ``edits`` per row.

    ``punctuation=False``: texts go through ``no_punct`` (SCL10) first; ``True``: raw
    white-space words (the with-punctuation WER of AGG3)."""
    return _scored(df, pred, ref, {"": F.col if punctuation else X.bare})


def _scored(df: DataFrame, pred: str, ref: str, kinds: dict) -> DataFrame:
    """``ref_words`` and ``edits`` of every kind of words (suffix of the columns -> the text that is split into
    them).  Raw texts are scored in the pass that normalises them, the others in the next one."""
    out = df.withColumns({f"_d{k}": X.text_distance(f(pred), f(ref)) for k, f in kinds.items()})
    out = out.withColumns({f"{c}{k}": F.col(f"_d{k}.{v}") for k in kinds for c, v in (("ref_words", "words"), ("edits", "edits"))})
    return out.drop(*[f"_d{k}" for k in kinds])


def wer_value(edits: Column, words: Column) -> Column:
    return F.when(words == 0, F.lit(float("inf"))).otherwise(edits.cast("double") / words)


def wer(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG1/AGG2: corpus WER per group from per-row ``edits`` and ``ref_words``."""
    g = scored.groupBy(*(by or []))
    out = g.agg(F.sum("edits").cast("long").alias("edits"),
                F.sum("ref_words").cast("long").alias("words"),
                F.count(F.lit(1)).alias("rows"))
    return out.withColumn("wer", wer_value(F.col("edits"), F.col("words")))


def quality_report(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG3: per group WER with punctuation (raw words), without (SCL10), samples,
    band and text of the punctuation-free value (SCL13)."""
    both = _scored(pairs, "prediction", "reference", {"_raw": F.col, "": X.bare})
    g = both.groupBy(*(by or []))
    out = g.agg(F.sum("edits_raw").alias("e_raw"), F.sum("ref_words_raw").alias("w_raw"),
                F.sum("edits").alias("e_np"), F.sum("ref_words").alias("w_np"),
                F.count(F.lit(1)).alias("samples"))
    out = (out.withColumn("wer", wer_value(F.col("e_raw"), F.col("w_raw")))
              .withColumn("wer_no_punct", wer_value(F.col("e_np"), F.col("w_np"))))
    return (out.withColumn("band", X.wer_band("wer_no_punct"))
               .withColumn("wer_no_punct_text", X.wer_text("wer_no_punct"))
               .drop("e_raw", "w_raw", "e_np", "w_np"))
