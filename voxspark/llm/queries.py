"""The registered queries: each operator over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (capfilter, chat, decontaminate, html_extract, jaccard, mixing, packing, pii, quality, sharding, spelling, token_count,
               whitening)
from .common import table

SHARDS = [f"shard-{i:04d}" for i in range(256)]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; every operator takes it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


@query
def op1_shard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.shard(docs, "doc_id", SHARDS).select("doc_id", "slot", "shard_id")


def _op1_sql() -> str:
    row = ",".join(map(str, sharding.fill(SHARDS)))
    return f"""
WITH t AS (SELECT string_split('{row}', ',') AS shards)
SELECT doc_id, slot, CAST(shards[slot + 1] AS INTEGER) AS shard_id
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE} AS slot
      FROM documents) d, t"""


ORACLE["op1_shard"] = _op1_sql()


@query
def op2_decontaminate(spark, sf_dir):
    got = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)
    return got.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "matched", "item_tokens", "first_token")


ORACLE["op2_decontaminate"] = decontaminate.ORACLE_SQL


@query
def op3_jaccard(spark, sf_dir):
    return jaccard.groups(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


@query
def op4_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    records = rows.unionByName(own).select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("payload"))
    return chat.read_back(chat.formatted(chat.canonical_turns(records, "conv_id", "turn", "payload")))


@query
def op5_html(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op6_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")).drop("ids")


@query
def op7_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op8_vectors(spark, sf_dir):
    return capfilter.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op9_token_count(spark, sf_dir):
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op11_mix(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op11_mix"] = mixing.ORACLE_SQL


@query
def op12_whiten(spark, sf_dir):
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
