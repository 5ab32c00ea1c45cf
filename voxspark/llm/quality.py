"""Quality classifier as a sparse rule ensemble.

Text statistics are plain column expressions.  A forest is grown on a bounded sample of
labelled rows, every path from a root to a node becomes a conjunctive rule over the
statistics, a lasso logistic fit keeps few rules and weighs them, and the result is
compiled into one column expression: scoring a table is a projection, no Python, no shuffle.

Learning takes at most ``max_rows`` labelled rows (those with the smallest hash of the id;
a documented bound), never held-out ones; scoring covers every row and whole text.
Labels, language, source and id are not inputs of the score.

Defined results: null and empty texts count as the empty text and get a score; labels that
are null are not learned from; with no labelled rows, or one class only, the score is the
(smoothed) share of label 1, 0.5 without any; repeated rows get equal scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD, FOLDS, MAX_ROWS = 0.3, 5, 8192


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; all finite, also for the empty text."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))

    def share(pattern: str) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / n

    def per_char(literal: str) -> Column:
        return (F.length(t) - F.length(F.replace(t, F.lit(literal), F.lit("")))) / n

    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1))
    return {
        "log_chars": F.log1p(F.length(t)),
        "word_length": F.length(t) / n_words,
        "line_words": n_words / n_lines,
        # logarithms, as the plain share falls with the length of clean prose too
        "distinct_words": F.log1p(F.size(F.array_distinct(words))) / F.log1p(n_words),
        "echoes": F.size(F.filter(F.arrays_zip(words.alias("w"), F.concat(F.array(F.lit("")), words).alias("v")),
                                  lambda x: x["w"] == x["v"])) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "symbols": share(r"[#$%&*=~^_\\/<>{}@+]+"),
        "bars": per_char("|"),
        "shouts": per_char("!"),
        "capitals": share(r"\p{Lu}+"),
        "digits": share(r"[0-9]+"),
        "stops": per_char("."),
        "other": share(r"[\p{L}\p{N}\s]+"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, is_upper_bound, threshold)``."""
    terms: tuple

    def condition(self, stats: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, [(stats[s] <= v) if upper else (stats[s] > v) for s, upper, v in self.terms])


def _simplified(path: list[tuple]) -> tuple:
    """The tightest bound per statistic and side, in a fixed order."""
    best: dict = {}
    for s, upper, v in path:
        k = (s, upper)
        best[k] = v if k not in best else (min if upper else max)(best[k], v)
    return tuple(sorted((s, u, v) for (s, u), v in best.items()))


def paths(debug: str, names: list[str]) -> list[Rule]:
    """Every path from the root to a node of the printed trees, as rules."""
    out, stack = set(), []
    for line in debug.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)", line)
        if m:
            depth = len(m[1])
            stack = [x for x in stack if x[0] < depth] + [(depth, (names[int(m[3])], m[4] == "<=", float(m[5])))]
            out.add(_simplified([x[1] for x in stack]))
        elif re.match(r" *Tree \d+", line):
            stack = []
    return [Rule(t) for t in sorted(out)]


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; ``score`` compiles them into a column expression over a text."""
    intercept: float
    rules: tuple

    def score(self, text: Column) -> Column:
        stats = statistics(text)
        return self.of_statistics(stats)

    def of_statistics(self, stats: dict[str, Column]) -> Column:
        z = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            z = z + F.when(rule.condition(stats), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", trees: int = 16, depth: int = 4, penalty: float = 0.003,
        max_rows: int = MAX_ROWS, seed: int = 7) -> RuleEnsemble:
    """Learn from at most ``max_rows`` labelled rows outside the held-out fold."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
              .where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
              .orderBy(F.xxhash64("id"), "id", "label").limit(max_rows))
    stats = statistics(F.col("text"))
    names = list(stats)
    # the sample is bounded by max_rows, so it may be broadcast and held in one partition
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
            .select("id", "label", *[c.alias(k) for k, c in stats.items()]))
    sample = rows.repartition(1).sortWithinPartitions("id", "label", *names)
    sample = VectorAssembler(inputCols=names, outputCol="features").transform(sample).select("label", "features").cache()
    count, ones = sample.agg(F.count("*"), F.sum("label")).first()
    ones = ones or 0.0
    if not 0 < ones < count:
        share = (ones + 1) / (count + 2)
        sample.unpersist()
        return RuleEnsemble(_logit(share), ())
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=max(2, int(count) // 400),
                                    featureSubsetStrategy="onethird", seed=seed).fit(sample)
    rules = paths(forest.toDebugString, names)
    if not rules:
        sample.unpersist()
        return RuleEnsemble(_logit(ones / count), ())
    from pyspark.ml.functions import vector_to_array

    flat = sample.select("label", vector_to_array("features").alias("f"))
    at = {k: F.col("f")[i] for i, k in enumerate(names)}
    table = flat.select("label", *[r.condition(at).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(table).cache()
    lasso = LogisticRegression(featuresCol="rules", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=False).fit(table)
    for x in (sample, table):
        x.unpersist()
    weighed = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if abs(w) > 1e-6]
    return RuleEnsemble(float(lasso.intercept), tuple(weighed))


def _logit(p: float) -> float:
    from math import log
    return log(p / (1 - p))


def scored(df: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every row.  The statistics are projected once,
    then the rules read them."""
    stats = statistics(F.col("text"))
    t = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", F.array(*[c.cast("double") for c in stats.values()]).alias("f"))
    z = model.of_statistics({k: F.col("f")[i] for i, k in enumerate(stats)})
    return (t.select("id", F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), z.alias("score"))
            .select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
