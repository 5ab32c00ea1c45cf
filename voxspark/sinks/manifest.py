"""Manifest and corpus writers (SNK1-SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_manifest(df: DataFrame, path: str, partition_by=("split",), mode: str = "overwrite"):
    """SNK1/SNK2: JSON lines (UTF-8, non-ASCII kept), one folder per split (and per
    any further partition column)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return path


def dealt(df: DataFrame, n: int, col: str = "manifest") -> DataFrame:
    """Rows dealt in turn to ``n`` manifests, their number in ``col`` (a partition column for ``write_manifest``):
    each task deals the rows it reads and adds its part to each folder, so no task holds a manifest whole."""
    return df.withColumn(col, (F.monotonically_increasing_id() % n).cast("int"))


def write_corpus(df: DataFrame, path: str, col: str = "text", mode: str = "overwrite"):
    """SNK3: one text per line."""
    df.select(F.col(col).cast("string")).write.mode(mode).text(path)
    return path
