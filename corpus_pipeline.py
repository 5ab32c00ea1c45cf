"""Corpus pipeline: quality, near duplicates, benchmark decontamination, personal data, packing.

Every stage takes the documents that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.  A row is recognised by a hash
of its id and text, so null ids and repeated rows are handled like any others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxspark.llm import decontaminate, jaccard, packing, pii, quality
from voxspark.llm.common import free_names, importable, table, written
from voxspark.llm.queries import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts (score of 0.3 or more)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) >= quality.THRESHOLD)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the
    one with the smallest id, repeated rows once.  Documents without words all stay."""
    importable(spark)
    found = jaccard.groups(docs, n=5, num=80, den=100)
    first = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    keep = found.where("component is not null").groupBy("component").agg(first.alias("key")).select("key")
    here, at = free_names(docs, "here", "key")
    keep = written(keep.union(found.where("component is null").select("key")).distinct().withColumnRenamed("key", at), "keep")
    kept = docs.withColumn(here, F.xxhash64("doc_id", "text")).join(keep, F.col(here) == F.col(at), "left_semi")
    return kept.dropDuplicates([here]).drop(here)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item, short items included."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), short=True)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts generalised."""
    out = pii.sanitise(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    importable(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("near_duplicates", dedup_stage), ("decontamination", decontaminate_stage),
          ("personal_data", pii_stage), ("packing", packing_stage)]
#: The classifier, the groups and the tokenizer can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
