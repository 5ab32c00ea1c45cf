"""Subset, custom fields, audio existence and audio bytes (JOIN1, JOIN2, JOIN4, JOIN5,
FLT5).  Join strategy is left to AQE: a side whose measured size is under the
broadcast threshold is broadcast, a hot key on a shuffled join is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shards import latest

def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def subset(all_rows: DataFrame, keep: DataFrame, key: str = "utt_id") -> DataFrame:
    """JOIN1: rows whose id is in the subset manifest (left semi join)."""
    return all_rows.join(keep.select(key), key, "left_semi")


def merge_custom(left: Column, right: Column) -> Column:
    """Right map wins per key; a null left map is empty (D-17)."""
    left = F.coalesce(left, _empty_map())
    right = F.coalesce(right, _empty_map())
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)


def attach_custom(all_rows: DataFrame, keep: DataFrame, key: str = "utt_id", *,
                  order: str) -> DataFrame:
    """JOIN2: inner join with the subset; its custom fields override per key.  With
    duplicate ids on the right the last one by its column ``order`` wins (WIN6)."""
    right = latest(keep.select(key, "custom", order), key, order).select(key, "custom")
    j = all_rows.join(right.withColumnRenamed("custom", "_rc"), key, "inner")
    left = F.col("custom") if "custom" in all_rows.columns else _empty_map()
    return j.withColumn("custom", merge_custom(left, F.col("_rc"))).drop("_rc")


def missing_audio(df: DataFrame, files: DataFrame, path: str = "audio_filepath",
                  file_col: str = "path") -> DataFrame:
    """JOIN4: manifest rows whose audio file is not in the listing (the error set)."""
    return df.join(files.select(F.col(file_col).alias(path)), path, "left_anti")


def with_audio(df: DataFrame, files: DataFrame, path: str = "audio_filepath",
               file_col: str = "path", content: str = "content") -> DataFrame:
    """JOIN5: attach audio bytes for packing (equi join on the path; the bytes column
    stays out of every plan until here)."""
    f = files.select(F.col(file_col).alias(path), F.col(content).alias("content"))
    return df.join(f, path, "inner")


def single_supervision_violations(cuts: DataFrame, sup: str = "supervisions") -> DataFrame:
    """FLT5: cuts that do not carry exactly one supervision."""
    return cuts.filter(F.coalesce(F.size(sup), F.lit(0)) != 1)
