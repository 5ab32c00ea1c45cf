"""Session construction and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names (a shared
file system); we only create a local one when the session has none, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "voxspark", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("VOX_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate files.

    Uses ``spark.checkpoint.dir`` (the shared folder a cluster names) or the context's
    checkpoint dir; only when neither is set (local runs, tests) does it create a local
    folder and make it the context's checkpoint dir (``spark.checkpoint.dir`` itself
    cannot be changed at run time).  A local-cluster or real cluster without the setting is
    an error: executors would write to their own disks."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="voxspark-ckpt-", dir=os.environ.get("VOX_SCRATCH", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)      # DataFrame.checkpoint() writes here
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_scope: ContextVar[list | None] = ContextVar("scope", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later passes see the same rows in
    the same order of files, and a lost executor costs a re-read.  Inside a ``scratch_scope``
    the files go when it ends."""
    path = scratch_path(df.sparkSession, name)
    if _scope.get() is not None:
        _scope.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop's API on the driver: any scheme that Spark itself reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes what ``written`` made inside once the results are out, as in each batch of a stream."""
    made: list[str] = []
    outer = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in made:
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)


def spread(df, key: str | None = None):
    """Hash-spread rows over the cluster's cores when the scan produced fewer partitions
    than the session's default parallelism (one large file or row group).  At scale
    the scan already has far more splits than cores and this is a no-op."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # a few tasks per core so a handful of very long texts do not set the pace
    n = 4 * cores
    return df.repartition(n, key) if key else df.repartition(n)
