"""Tar shard scan (SRC9): a header index, members paired with manifest rows, contents by byte range.

1. ``tar_index`` lists the tars with Spark's ``binaryFile`` source (content pruned) and walks their
   headers only, one tar a task row: (shard, tar, member, place, size).
2. ``pair`` joins manifest rows with the members they name.  Filters and subset joins before step
   3 decide which bytes are read at all.
3. ``attach_content`` deals rows out by tar and byte range, so that one large tar is read by several
   tasks, and reads members at their offsets in batches of bounded bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sinks.tar import file_system

INDEX = "shard_id int, tar string, member string, tar_offset long, size long"
#: Bytes of a tar that one task reads, and of the contents in one batch.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 16 << 20


def tar_index(spark: SparkSession, paths) -> DataFrame:
    """The members of all ``audio_<id>.tar`` under the folders ``paths``; ``tar_offset`` is where the content starts."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "audio_*.tar").option("recursiveFileLookup", "true")
             .load([paths] if isinstance(paths, str) else list(paths)).select("path"))

    def headers(batches):
        import re
        import tarfile

        import pyarrow as pa

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))], ["shard_id", "tar", "member", "tar_offset", "size"])

        for b in batches:
            for tar in b.column("path").to_pylist():
                filesystem, path = file_system(tar)
                sid = int(re.search(r"audio_(\d+)\.tar$", path).group(1))
                rows = []
                with filesystem.open_input_file(path) as fh, tarfile.open(fileobj=fh, mode="r:") as t:
                    for m in t:
                        t.members = []                            # headers already seen need no memory
                        if m.isfile():
                            rows.append((sid, tar, m.name, m.offset_data, m.size))
                        if len(rows) == 10_000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    return files.mapInArrow(headers, INDEX)


def pair(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Manifest rows (``shard_id``, ``audio_filepath``) with ``tar``, ``member``, ``tar_offset`` and ``size`` of the
    member they name; the n-th row of a repeated file (``base-sub<n>.ext``) has the member ``base.ext``,
    unless a member has that very name.  Rows without a member keep nulls there; manifest columns
    of those names are replaced."""
    rows = manifest.drop("member", "tar", "tar_offset", "size")
    base = F.regexp_replace("audio_filepath", r"-sub\d+(\.[^.]*)?$", "$1")
    m = index.select("shard_id", "member", "tar", "tar_offset", "size")
    own, same = m.toDF("_s", "_m", "_t", "_o", "_z"), m.toDF("_s2", "_m2", "_t2", "_o2", "_z2")
    found = rows.join(own, (F.col("shard_id") == F.col("_s")) & (F.col("audio_filepath") == F.col("_m")), "left")
    found = found.join(same, F.col("_m").isNull() & (F.col("shard_id") == F.col("_s2")) & (base == F.col("_m2")), "left")
    return found.select(*rows.columns, F.coalesce("_m", "_m2").alias("member"), F.coalesce("_t", "_t2").alias("tar"),
                        F.coalesce("_o", "_o2").alias("tar_offset"), F.coalesce("_z", "_z2").alias("size"))


def attach_content(rows: DataFrame, split_bytes: int = SPLIT_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``rows`` (with ``tar``, ``tar_offset``, ``size``) and the bytes of their member as ``content``; null where ``tar`` is."""
    from pyspark.sql.types import BinaryType, StructField, StructType
    rows = rows.drop("content")
    schema = StructType(rows.schema.fields + [StructField("content", BinaryType())])
    # a given number: index rows are small, and adaptive execution would put the ranges together by their size
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "tar", F.floor(F.col("tar_offset") / split_bytes)).sortWithinPartitions("tar", "tar_offset")

    def read(batches):
        import pyarrow as pa
        now, fh = None, None

        def out(batch, start, got):
            part = batch.slice(start, len(got))
            return pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.binary())], [*part.schema.names, "content"])

        for b in batches:
            start, held, got = 0, 0, []
            for tar, offset, size in zip(*(b.column(c).to_pylist() for c in ("tar", "tar_offset", "size"))):
                if tar is None:
                    got.append(None)
                    continue
                if held + size > batch_bytes and got:
                    yield out(b, start, got)
                    start, held, got = start + len(got), 0, []
                if tar != now:
                    if fh is not None:
                        fh.close()
                    filesystem, path = file_system(tar)
                    now, fh = tar, filesystem.open_input_file(path)
                got.append(fh.read_at(size, offset))
                held += size
            if got:
                yield out(b, start, got)
        if fh is not None:
            fh.close()

    return dealt.mapInArrow(read, schema)


def read_shards(spark: SparkSession, path: str, with_content: bool = False) -> DataFrame:
    """Members of the tars under ``path``: ``shard_id, member, size`` and, if asked for, ``content``."""
    index = tar_index(spark, path)
    return attach_content(index).select("shard_id", "member", "size", "content") if with_content else index.select("shard_id", "member", "size")


def read_entries(spark: SparkSession, paths) -> DataFrame:
    """Rows of all ``manifest_<id>.json`` under the folders ``paths`` (SRC10: metadata only); no such file,
    no rows."""
    from .manifest import parse_lines
    try:
        raw = (spark.read.option("pathGlobFilter", "manifest_*.json").option("recursiveFileLookup", "true")
               .text([paths] if isinstance(paths, str) else list(paths)))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], "value string")
    return parse_lines(raw).where("not is_error").drop("is_error", "has_text_key", "line")
