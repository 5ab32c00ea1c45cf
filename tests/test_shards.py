"""Global index and shard planning (H-2, WIN1-WIN6, AGG6 fixture)."""
from pyspark.sql import functions as F

from conftest import SF

from voxspark.operators import index as I
from voxspark.operators import manifest as M
from voxspark.operators import shards as H
from voxspark.plans import views as V
from voxspark.session import scratch_scope
from voxspark.sources import manifest as S


def test_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5000)
    ix = I.with_index(df, ["k"]).collect()
    assert sorted(r.idx for r in ix) == list(range(5000))
    assert all(r.idx == r.k for r in ix)


def test_shard_even_and_append(spark):
    df = spark.range(10).withColumn("utt_id", F.col("id").cast("string"))
    kept, dropped = H.shard_even(df, 3, ["id"])
    sizes = [r["count"] for r in kept.groupBy("shard_id").count().collect()]
    assert sorted(sizes) == [3, 3, 3] and dropped.count() == 1
    kept, dropped = H.shard_append(df, 4, 7, ["id"])
    assert sorted(r.shard_id for r in kept.select("shard_id").distinct().collect()) == [7, 8]
    assert dropped.count() == 2
    kept, dropped = H.shard_append(df.limit(8), 4, 0, ["id"])
    assert kept.count() == 8 and dropped.count() == 0          # D-1: remainder 0 keeps all


def test_number_repeats(spark):
    df = spark.createDataFrame([(0, "a.wav", i) for i in range(3)], "shard_id int, audio_filepath string, pos long")
    got = [r.member for r in H.number_repeats(df).orderBy("pos").collect()]
    assert got == ["a.wav", "a-sub1.wav", "a-sub2.wav"]


def test_latest_keeps_last(spark):
    df = spark.createDataFrame([("x", 1, "old"), ("x", 2, "new"), ("y", 1, "only")], "k string, v int, t string")
    assert sorted((r.k, r.t) for r in H.latest(df, "k", "v").collect()) == [("x", "new"), ("y", "only")]


def test_corpus_stats_fixture(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"text":"a"}\n{"text":" a "}\n{"text":""}\n{}\nnot json\n\n', encoding="utf-8")
    s = M.corpus_stats(S.read_manifest_lines(spark, str(p))).collect()[0]
    assert (s.processed, s.unique, s.duplicates, s.errors) == (2, 1, 1, 3)


def test_scan_reference_layout(spark, tmp_path):
    for ds, split in [("d1", "train"), ("d1", "test"), ("d2", "train")]:
        d = tmp_path / "datasets" / ds
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{split}_manifest.jsonl").write_text('{"audio_filepath": "x.wav", "duration": 1.0, "extra": 5}\n')
    df = S.scan_manifests(spark, str(tmp_path / "datasets"), exclude=["d2"])
    got = sorted((r.dataset, r.split, r.custom["extra"]) for r in df.collect())
    assert got == [("d1", "test", "5"), ("d1", "train", "5")]


def test_index_takes_ties_nulls_and_groups(spark):
    rows = [("a", 1), ("a", 1), ("a", None), (None, 2), (None, 2), (None, None), ("b", 5)] * 3
    df = spark.createDataFrame(rows, "g string, v int")
    ix, n = I.indexed(df, ["g", "v"], group=1)
    got = ix.collect()
    assert n == len(rows) and sorted(r.idx for r in got) == list(range(n))
    key = lambda r: (r.g is not None, r.g or "", r.v is not None, r.v or 0)
    assert [key(r) for r in sorted(got, key=lambda r: r.idx)] == sorted(map(key, got))
    for g in ("a", "b", None):
        part = [r for r in got if r.g == g]
        assert sorted(r.pos for r in part) == list(range(len(part)))
    empty, none = I.indexed(df.where("false"), ["g"], group=1)
    assert none == 0 and empty.collect() == []


def test_rows_without_a_file_are_kept(spark):
    df = spark.createDataFrame([(0, None, 0), (0, None, 1), (0, "a.wav", 2), (None, "a.wav", 0)],
                               "shard_id int, audio_filepath string, pos long")
    got = sorted((str(r.shard_id), str(r.member), r.repeat) for r in H.number_repeats(df).collect())
    assert got == [("0", "None", 0), ("0", "None", 1), ("0", "a.wav", 0), ("None", "a.wav", 0)]


def test_wide_columns_are_not_sorted_or_cached(spark):
    """The index shuffles order columns alone; text is read only where it is asked for, and
    nothing stays cached."""
    before = spark._jsc.sc().getPersistentRDDs().size()
    df = V.v_repeats(spark, SF)
    kept, _ = H.shard_even(df, 4, H.shuffle_key(42))
    rows = H.number_repeats(H.order_in_shard(kept))
    plan = rows.select("utt_id", "member")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "InMemoryRelation" not in plan
    assert rows.count() > 0 and spark._jsc.sc().getPersistentRDDs().size() == before


def test_scratch_scope_deletes_its_files(spark):
    import os
    with scratch_scope(spark):
        ix = I.with_index(spark.range(100), ["id"])
        files = [f for f in ix.inputFiles()]
        assert files and ix.count() == 100
    assert not any(os.path.exists(f.replace("file:", "").replace("//", "/", 1)) for f in files)


def test_no_task_takes_a_shard_whole(spark, tmp_path):
    """A shard of many rows is written by several tasks; its files, by name, hold the rows in order."""
    from voxspark.sinks.shards import write_shards
    df = spark.range(40_000).select((F.col("id") % 2).cast("int").alias("shard_id"), F.floor(F.col("id") / 2).alias("pos"),
                                    F.concat(F.col("id").cast("string"), F.lit(".wav")).alias("member"),
                                    F.sha2(F.col("id").cast("string"), 512).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_shards(df.repartition(6), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for shard in (0, 1):
        files = sorted((tmp_path / f"out/sharded_manifests/shard_id={shard}").glob("part-*"))
        rows = [line for f in files for line in f.read_text().splitlines()]
        assert len(files) > 1 and len(rows) == 20_000
        assert [int(r.split('"pos":')[1].split(",")[0]) for r in rows] == list(range(20_000))
