"""The sharder as one job: data sets, versions, paired reading (SNK4-SNK6, SRC9)."""
import os
import tarfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from voxspark.session import scratch_path
from voxspark.sinks import build as BD
from voxspark.sinks import shards as KS
from voxspark.sinks import tar as T
from voxspark.sources import shards as SS

ROWS = "utt_id string, audio_filepath string, duration double, text string, speaker string"


def rows(spark, ids, files=5):
    return spark.createDataFrame([(f"u{i:03d}", f"clips/{i % files}.wav", float(i % 7), f'said "{i}"\n€', "s") for i in ids], ROWS)


def store(spark, files=5):
    return spark.createDataFrame([(f"clips/{k}.wav", bytes([65 + k]) * (100 * k + 1)) for k in range(files)], "path string, content binary")


def test_new_data_set_append_and_read_at_a_version(spark):
    root = scratch_path(spark, "ds")
    made = BD.create(rows(spark, range(43)), store(spark), root, {"num_shards": 4, "shuffle": True, "shuffle_seed": 1})
    assert (made["version"], made["num_samples_per_shard"], made["is_concatenated_manifest"]) == (0, 10, False)
    more = BD.append(rows(spark, range(100, 125)), store(spark), root)
    assert (more["version"], more["dataset_config"]["num_shards"], len(more["history"])) == (1, 6, 1)
    for version, shards in ((0, 4), (None, 6)):
        got = BD.read(spark, root, version).collect()
        assert len(got) == 10 * shards and {r.shard_id for r in got} == set(range(shards))
        for s in range(shards):
            mine = [r for r in got if r.shard_id == s]
            # a file of several rows is stored once; its other rows are named after it
            assert len({r.audio_filepath for r in mine}) == 10 and {r.member for r in mine} == {
                m.replace("-sub1", "").replace("-sub2", "").replace("-sub3", "").replace("-sub4", "") .replace("-sub5", "").replace("-sub6", "")
                .replace("-sub7", "").replace("-sub8", "").replace("-sub9", "") for m in (r.audio_filepath for r in mine)}
        assert all(r.size == 100 * int(r.member.split("_")[-1][0]) + 1 and r.custom == {"speaker": "s"} for r in got)
        assert all(r.text == f'said "{int(r.utt_id[1:])}"\n€' for r in got)
    counted = {r.shard_id: (r.rows, r.files) for r in BD.shard_list(spark, root).collect()}
    folder = BD.folders(spark, root, 0)[0]
    assert sorted(os.listdir(folder)) == sorted([f"audio_{k}.tar" for k in range(4)] + [f"manifest_{k}.json" for k in range(4)] + ["shards.json"])
    for k in range(4):
        with tarfile.open(f"{folder}/audio_{k}.tar") as t:
            names = t.getnames()
        assert len(set(names)) == len(names) == counted[k][1] and counted[k][0] == 10


def test_order_inside_a_shard(spark):
    root = scratch_path(spark, "ds")
    BD.create(rows(spark, range(20)), store(spark), root, {"num_shards": 1})
    with open(f"{BD.folders(spark, root)[0]}/manifest_0.json", encoding="utf-8") as f:
        import json
        lengths = [json.loads(x)["duration"] for x in f]
    assert lengths == sorted(lengths) and len(lengths) == 20


def test_a_missing_file_leaves_nothing(spark):
    root = scratch_path(spark, "ds")
    with pytest.raises(Exception, match="audio file not found: clips/4.wav"):
        BD.create(rows(spark, range(10)), store(spark, 4), root, {"num_shards": 2})
    assert KS.latest_version(spark, f"{root}/metadata") is None
    assert not os.path.exists(root) or os.listdir(root) == []


def test_no_rows_and_bad_settings(spark):
    root = scratch_path(spark, "ds")
    assert BD.create(rows(spark, []), store(spark), root, {"num_shards": 2}) == {}
    with pytest.raises(ValueError):
        BD.create(rows(spark, [1]), store(spark), root, {"num_shards": 0})
    with pytest.raises(ValueError):
        BD.create(rows(spark, [1]), store(spark), root, {"shards": 3})
    with pytest.raises(ValueError):
        BD.append(rows(spark, [1]), store(spark), root)


def test_the_slower_of_two_appends_numbers_on(spark, monkeypatch):
    """While one append writes, another commits: the first does its shards again behind them."""
    root = scratch_path(spark, "ds")
    BD.create(rows(spark, range(10)), store(spark), root, {"num_shards": 2})
    write, raced = BD.write_planned, []

    def slow(*a, **k):
        write(*a, **k)
        if not raced:
            raced.append(1)
            BD.append(rows(spark, range(100, 105)), store(spark), root)
    monkeypatch.setattr(BD, "write_planned", slow)
    last = BD.append(rows(spark, range(200, 210)), store(spark), root)
    assert last["version"] == 2 and last["dataset_config"]["num_shards"] == 5
    got = BD.read(spark, root).groupBy("shard_id").agg(F.count("*").alias("n"), F.min("utt_id").alias("u")).collect()
    assert {r.shard_id: r.n for r in got} == {k: 5 for k in range(5)}
    assert {r.shard_id: r.u[1] for r in got} == {0: "0", 1: "0", 2: "1", 3: "2", 4: "2"}
    assert len([d for d in os.listdir(root) if d.startswith("build-")]) == 3


def test_concurrent_versions_are_never_the_same(spark):
    path = scratch_path(spark, "meta")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: KS.append_version(spark, path, {"num_shards": k}, 10, True), range(6)))
    got = KS.read_versions(spark, path).orderBy("version").collect()
    assert [r.version for r in got] == [1, 2, 3, 4, 5, 6]
    assert sorted(r.dataset_config.num_shards for r in got) == list(range(6))
    for k, r in enumerate(got):                       # each holds those before it
        assert [h.version for h in r.history] == list(range(1, k + 1))
    assert KS.read_versions(spark, path, 3).count() == 3
    assert not KS.put_if_absent(spark, f"{path}/00000004.json", "x") and KS.put_if_absent(spark, f"{path}/00000007.json", "{}")
    assert not [n for n in os.listdir(path) if n.startswith(".") and not n.endswith(".crc")]


def test_blank_record(spark):
    r = KS.default_record(spark).first()
    assert (r.version, r.num_samples_per_shard, r.is_concatenated_manifest, r.history) == (0, None, False, [])
    assert r.dataset_config.sort_in_shards and r.dataset_config.shard_manifests and r.dataset_config.num_shards == -1
    assert len(r.created_datetime) == 19


def test_one_large_tar_is_read_by_several_tasks_in_bounded_batches(spark):
    content = F.unhex(F.repeat(F.lpad(F.hex(F.col("id") % 256), 2, "0"), 2000))
    df = spark.range(300).select(F.lit(0).alias("shard_id"), F.col("id").alias("pos"),
                                 F.concat(F.lit("m"), F.col("id").cast("string"), F.lit(".wav")).alias("member"), content.alias("content"))
    path = scratch_path(spark, "tars")
    T.write_tar_shards(df, path)
    index = SS.tar_index(spark, path)
    read = SS.attach_content(index, split_bytes=50_000, batch_bytes=10_000)
    got = read.select("member", "content", F.spark_partition_id().alias("task")).collect()
    assert len(got) == 300 and len({r.task for r in got}) > 2
    assert all(bytes(r.content) == bytes([int(r.member[1:-4]) % 256]) * 2000 for r in got)


def test_pair_prefers_the_very_name(spark):
    index = spark.createDataFrame([(0, "t", "a.wav", 1, 1), (0, "t", "a-sub1.wav", 2, 2), (0, "t", "b", 3, 3)], SS.INDEX)
    rows = spark.createDataFrame([(0, "a.wav"), (0, "a-sub1.wav"), (0, "a-sub2.wav"), (0, "b-sub1"), (0, "c.wav"), (1, "a.wav")],
                                 "shard_id int, audio_filepath string")
    got = {(r.shard_id, r.audio_filepath): r.member for r in SS.pair(rows, index).collect()}
    assert got == {(0, "a.wav"): "a.wav", (0, "a-sub1.wav"): "a-sub1.wav", (0, "a-sub2.wav"): "a.wav", (0, "b-sub1"): "b",
                   (0, "c.wav"): None, (1, "a.wav"): None}


def test_subset_export(spark):
    root, out = scratch_path(spark, "ds"), scratch_path(spark, "sub")
    BD.create(rows(spark, range(20)), store(spark), root, {"num_shards": 2})
    keep = spark.createDataFrame([("u003", {"q": "1"}, 1), ("u003", {"q": "2", "speaker": "t"}, 2), ("u011", {"duration": "9.5"}, 1), ("x", {}, 1)],
                                 "utt_id string, custom map<string,string>, v int")
    BD.export_subset(spark, root, keep, out, order="v", shard_size=1)
    got = sorted(SS.pair(SS.read_entries(spark, out), SS.tar_index(spark, out)).collect(), key=lambda r: r.utt_id)
    assert [(r.utt_id, r.shard_id, r.audio_filepath, r.duration, r.custom, r.size) for r in got] == [
        ("u003", 0, "u003.wav", 3.0, {"speaker": "t", "q": "2"}, 301), ("u011", 1, "u011.wav", 9.5, {"speaker": "s"}, 101)]
