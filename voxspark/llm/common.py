"""Helpers shared by the training-data operators: table reads, lineage cuts, components."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxspark.session import scratch_path


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the driver's checkout, as in tests; a
    cluster gets the package by ``--py-files`` or its image, where this changes nothing."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared scratch folder (``spark.checkpoint.dir``) and reread.
    A lost executor then costs a re-read, not a recomputation of everything before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` as ``(id, component)``, component = the
    smallest id reachable.  Alternating large-star / small-star steps: every step is one
    min-aggregate (combined map-side) and one equi join, and the edge table never grows,
    so a node with a third of all edges costs no more than its own rows.  Each round is
    written to the shared folder; the loop ends when the edges are stars, that is when no id
    has two parents or is both parent and child (O(log n) rounds in practice; ``max_rounds``
    only guards against a bug and raises).  Null ends and self loops are ignored; no edges
    give no rows."""
    def settled(df: DataFrame) -> bool:
        ends = df.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
            df.select("v", F.lit(0), F.lit(1)))
        return not (ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
                    .where("child > 1 or child + parent > 1").agg(F.count("*")).first()[0])

    e = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                .where("u is not null and v is not null and u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        if settled(e):
            break
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        e = written(large.join(low2, "u").select(F.greatest("v", "u").alias("u0"), "v", "u", "m")
                    .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct("u", F.col("m").alias("v")))).alias("x"))
                    .select("x.u", "x.v").where("u <> v").distinct(), "links")
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
