"""Tar shard sink (SNK4 + SNK5): a Python Data Source writer whose tasks write each shard's tar and
its manifest together.

Rows arrive clustered by ``shard_id`` and ordered by position.  A task streams every shard it
holds to hidden files through pyarrow's file systems; the commit, on the driver, moves those
of the successful attempts into place and writes the list of shards (a line a shard: rows,
files, bytes).  A retried or speculative attempt leaves nothing that is read, an aborted
write leaves no folder at all.  A file that several rows name is stored once per shard.
"""

from __future__ import annotations

import io
import json
import posixpath
import tarfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import hadoop_path

#: Rows of an Arrow batch on the way to the writer: bounds the audio bytes in memory.
BATCH_ROWS = 64
SHARDS = "shards.json"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: without one it is Spark's default file system, on the driver and in
    every task alike, not the disk of the executor that reads the name."""
    fs, p = hadoop_path(spark, path)
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def file_system(uri: str):
    """pyarrow file system and path of a URI (local files, HDFS, S3, GCS)."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class _Written(WriterCommitMessage):
    def __init__(self, shards):
        self.shards = shards                  # (shard id, attempt, rows, files, bytes)


class _Shard:
    """One shard being written: a tar and a manifest under hidden names."""

    def __init__(self, filesystem, root, shard_id):
        self.id, self.attempt = shard_id, uuid.uuid4().hex
        self.rows = self.files = self.bytes = 0
        self.names = set()
        self.audio = filesystem.open_output_stream(_hidden(root, "audio", shard_id, self.attempt, "tar"))
        self.tar = tarfile.open(fileobj=self.audio, mode="w|")              # streamed, no seeks
        self.manifest = filesystem.open_output_stream(_hidden(root, "manifest", shard_id, self.attempt, "json"))

    def add(self, member, content, entry):
        self.rows += 1
        if entry is not None:
            self.manifest.write((entry + "\n").encode())
        if content is None or member in self.names:
            return
        self.names.add(member)
        info = tarfile.TarInfo(member)
        info.size = len(content)
        self.tar.addfile(info, io.BytesIO(content))
        self.files += 1
        self.bytes += info.size

    def close(self):
        self.tar.close()
        self.audio.close()
        self.manifest.close()
        return self.id, self.attempt, self.rows, self.files, self.bytes


def _hidden(root, kind, shard_id, attempt, ext):
    return posixpath.join(root, f".{kind}_{shard_id}.{attempt}.{ext}")


class _ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, manifests: bool):
        self.path, self.manifests = path, manifests

    def write(self, iterator):
        filesystem, root = file_system(self.path)
        filesystem.create_dir(root, recursive=True)
        shard, done = None, []
        for batch in iterator:
            ids, members = batch.column("shard_id").to_pylist(), batch.column("member").to_pylist()
            content, entry = batch.column("content"), batch.column("entry")
            for k, (sid, member) in enumerate(zip(ids, members)):
                if shard is None or sid != shard.id:
                    if shard is not None:
                        done.append(shard.close())
                    shard = _Shard(filesystem, root, sid)
                shard.add(member, content[k].as_py(), entry[k].as_py())
        if shard is not None:
            done.append(shard.close())
        return _Written(done)

    def commit(self, messages):
        from pyarrow import fs
        filesystem, root = file_system(self.path)
        filesystem.create_dir(root, recursive=True)
        lines = []
        for sid, attempt, rows, files, size in sorted(s for m in messages if m is not None for s in m.shards):
            filesystem.move(_hidden(root, "audio", sid, attempt, "tar"), posixpath.join(root, f"audio_{sid}.tar"))
            if self.manifests:
                filesystem.move(_hidden(root, "manifest", sid, attempt, "json"), posixpath.join(root, f"manifest_{sid}.json"))
            lines.append(json.dumps({"shard_id": sid, "rows": rows, "files": files, "bytes": size}))
        for left in filesystem.get_file_info(fs.FileSelector(root)):          # of other attempts
            if left.base_name.startswith((".audio_", ".manifest_")):
                filesystem.delete_file(left.path)
        with filesystem.open_output_stream(posixpath.join(root, SHARDS)) as out:
            out.write(("".join(x + "\n" for x in lines)).encode())

    def abort(self, messages):
        from pyarrow import fs
        filesystem, root = file_system(self.path)
        if filesystem.get_file_info(root).type != fs.FileType.NotFound:
            filesystem.delete_dir(root)


class TarShardSource(DataSource):
    @classmethod
    def name(cls):
        return "tarshard"

    def writer(self, schema, overwrite):
        return _ShardWriter(self.options["path"], self.options.get("manifests", "true") == "true")


def write_tar_shards(df: DataFrame, path: str, manifests: bool = True) -> str:
    """SNK4 + SNK5: ``df`` holds ``shard_id, pos, member, content`` and, for the manifests, ``entry`` (a JSON
    line a row, null for none).  ``content`` may be null in rows that repeat a member.  One
    shuffle, by shard; ``path`` must be new."""
    spark = df.sparkSession
    spark.dataSource.register(TarShardSource)
    if "entry" not in df.columns:
        df, manifests = df.withColumn("entry", F.lit(None).cast("string")), False
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(BATCH_ROWS))
    try:
        (df.select("shard_id", "pos", "member", "content", "entry")
         .repartition("shard_id").sortWithinPartitions("shard_id", "pos")
         .write.format("tarshard").option("manifests", str(manifests).lower()).mode("append").save(qualified(spark, path)))
    finally:
        spark.conf.set(size, before)
    return path
