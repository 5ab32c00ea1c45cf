"""Input specs, field mapping, shard errors, names and the stream = batch check."""
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from voxspark.functions import naming as N
from voxspark.functions import text as X
from voxspark.operators import shards as H
from voxspark.plans import views as V
from voxspark.session import scratch_path
from voxspark.sinks import shards as KS
from voxspark.sources import manifest as S
from voxspark.streaming import manifest as ST


def test_resolve_input_forms(spark, tmp_path):
    def found(spec):
        return [(i.kind, i.path, i.weight) for i in S.resolve_inputs(spark, spec)]
    inner = tmp_path / "inner.yaml"
    inner.write_text("- manifest_filepath: /c\n  weight: 4\n")
    y = tmp_path / "in.yaml"
    y.write_text(f"input_cfg:\n- manifest_filepath: /a\n  weight: 2\n- weight: 0.5\n  input_cfg:\n  - shar_path: /s\n    weight: 3\n"
                 f"  - input_cfg: {inner}\n- cuts_path: /b\n")
    tree = [("manifest", "/a", 2.0), ("shards", "/s", 1.5), ("manifest", "/c", 2.0), ("manifest", "/b", 1.0)]
    assert found(str(y)) == found(f"input_cfg={y}") == tree
    assert found([["/a", 3], [str(inner), 0.5]]) == [("manifest", "/a", 3.0), ("manifest", "/c", 2.0)]
    assert found("[[/a,3],[/b]]") == [("manifest", "/a", 3.0), ("manifest", "/b", 1.0)]
    assert found("/a,/b") == found(["/a", "/b"]) == [("manifest", "/a", 1.0), ("manifest", "/b", 1.0)]
    assert found("manifest_filepath=/a") == [("manifest", "/a", 1.0)]
    shar = tmp_path / "shar"
    shar.mkdir()
    (shar / "cuts.000000.jsonl").write_text('{"utt_id": "x"}\n{"utt_id": "y", "language": "z"}\n')
    (shar / "cuts.000001.jsonl").write_text('{"utt_id": "w"}\n')
    (shar / "language.000000.jsonl").write_text("de\nfr\n")
    assert found(str(shar)) == found(f"shar_path={shar}") == [("shards", str(shar), 1.0)]
    rows = sorted((r.utt_id, r.shard_id, r.custom) for r in S.read_shard_folder(spark, str(shar)).collect())
    assert rows == [("w", 1, {}), ("x", 0, {"language": "de"}), ("y", 0, {"language": "fr"})]
    loop = tmp_path / "loop.yaml"
    loop.write_text(f"input_cfg:\n- input_cfg: {loop}\n")
    for bad in (str(loop), "nothing=/a"):
        with pytest.raises(ValueError):
            S.resolve_inputs(spark, bad)


def test_dataset_names_below_a_root_that_repeats(spark, tmp_path):
    """The root's last name further up, signs of patterns and blanks in names."""
    root = tmp_path / "data (a+b)" / "x" / "data (a+b)"
    for ds in ("data (a+b)", "d 2"):
        (root / ds).mkdir(parents=True)
        (root / ds / "train_manifest.jsonl").write_text('{"audio_filepath": "x.wav", "duration": 1.0}\n')
    got = S.scan_manifests(spark, str(root)).select("dataset", "split").collect()
    assert sorted(map(tuple, got)) == [("d 2", "train"), ("data (a+b)", "train")]


def test_wav_duration_follows_chunks(spark):
    from voxspark.operators import manifest as M

    def riff(*chunks, size=None):
        body = b"".join(n + len(c).to_bytes(4, "little") + c + b"\0" * (len(c) % 2) for n, c in chunks)
        return b"RIFF" + (4 + len(body)).to_bytes(4, "little") + b"WAVE" + body
    fmt = (b"fmt ", bytes.fromhex("01000100") + (8).to_bytes(4, "little") + (16).to_bytes(4, "little") + bytes.fromhex("02001000"))
    data = (b"data", b"\1" * 40)
    files = {"plain": riff(fmt, data), "list": riff(fmt, (b"LIST", b"INFOabc"), data), "odd": riff((b"junk", b"xyz"), fmt, (b"fact", b"1234"), data),
             "after": riff(fmt, data, (b"id3 ", b"12345")), "long fmt": riff((b"fmt ", fmt[1] + b"\0" * 24), data), "no data": riff(fmt),
             "no fmt": riff(data), "no wav": b"OggS" + b"\0" * 60, "short": b"RIFF", "cut": riff(fmt, data)[:-20], "empty": b"", "none": None}
    df = spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in files.items()], "k string, c binary")
    got = {r.k: r.s for r in df.select("k", M.wav_duration(F.col("c")).alias("s")).collect()}
    assert got == {"plain": 2.5, "list": 2.5, "odd": 2.5, "after": 2.5, "long fmt": 2.5, "no data": None, "no fmt": None, "no wav": None,
                   "short": None, "cut": 1.25, "empty": None, "none": None}


def test_pairs_by_position(spark):
    from voxspark.operators import wer as W
    h = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "line long, prediction string")
    r = spark.createDataFrame([(10, "A"), (20, "B")], "at long, reference string")
    got = W.pair_by_position(h, r, ["line"], ["at"]).orderBy("position").collect()
    assert [(x.position, x.prediction, x.reference) for x in got] == [(0, "a", "A"), (1, "b", "B")]


def test_field_mapping_and_audio_key(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text('{"audio_file": "x.wav", "duration": 1.5, "sentence": "hi", "language": "de"}\n')
    df = S.read_manifest(spark, str(p), text_field="sentence", lang_field="language").collect()[0]
    assert (df.audio_filepath, df.text, df.lang, df.duration) == ("x.wav", "hi", "de", 1.5)


def test_shard_errors(spark):
    df = spark.range(2).withColumn("utt_id", F.col("id").cast("string"))
    with pytest.raises(ValueError):
        H.shard_even(df, 0, ["id"])                  # D-3
    with pytest.raises(ValueError):
        H.shard_even(df, 5, ["id"])                  # D-2


def test_names_and_stamp(spark):
    row = spark.range(1).select(
        N.experiment_name(F.lit("min"), F.lit(True), F.lit(False), F.lit("entropy"), F.lit(0.5),
                          F.lit("tsallis"), F.lit("exp")).alias("e1"),
        N.experiment_name(F.lit("prod"), F.lit(False), F.lit(True), F.lit("max_prob"), F.lit(0.33)).alias("e2"),
        N.vocab_name(F.lit("spe"), F.lit("bpe"), F.lit(512), F.lit(4), F.lit(True), F.lit(False),
                     F.lit(True)).alias("v"),
        KS.stamp().alias("t")).collect()[0]
    assert row.e1 == "min-no_blank-no_duration-entropy-tsallis-exp-0.5"
    assert row.e2 == "prod-blank-duration-max_prob-0.33"
    assert row.v == "tokenizer_spe_bpe_v512_max_4_pad_eos"
    assert re.fullmatch(r"\d\d-\d\d-\d{4} \d\d-\d\d-\d\d", row.t)


def test_stream_equals_batch(spark):
    """Clean rows with their own keys, bad lines aside; a batch that crashed or comes again counts once."""
    m = V.v_manifest(spark, SF).withColumn("zzz", F.lit("own"))
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    m.repartition(3, "utt_id").write.json(src)
    spark.createDataFrame([("not json",), ("[1]",), ("",)], "value string").coalesce(1).write.mode("append").text(src)
    for _ in range(2):                      # a new checkpoint: all batches again
        ST.run_with_quarantine(ST.stream_manifest(spark, src), out)
    # what an attempt without a commit left does not count
    spark.createDataFrame([("left",)], "line string").write.parquet(f"{out}/flagged/batch_id=99")
    rows = ST.read_quarantined(spark, out, "rows").collect()
    exp = sorted((r.utt_id, r.t) for r in m.select("utt_id", X.clean_text("text").alias("t")).collect())
    assert sorted((r.utt_id, r.text) for r in rows) == exp and all(r.custom["zzz"] == "own" for r in rows)
    assert sorted(r.line for r in ST.read_quarantined(spark, out, "flagged").collect()) == ["[1]", "not json"]


def test_stream_dedup_with_watermark(spark):
    src = scratch_path(spark, "dd")
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:20:00")]
    spark.createDataFrame(rows, "text string, ts string").withColumn("ts", F.to_timestamp("ts")) \
        .repartition(2).write.json(src)
    s = spark.readStream.schema("text string, ts timestamp").json(src)
    out = ST.run_to_files(ST.stream_dedup(s, event_time="ts"), scratch_path(spark, "ddo"))
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_stream_append_is_idempotent(spark):
    from voxspark.sinks.shards import read_versions
    m = V.v_manifest(spark, SF).select("utt_id", "split", "duration", "text")
    src = scratch_path(spark, "arr")
    m.repartition(3, "utt_id").write.json(src)
    root = scratch_path(spark, "app")
    for _ in range(2):                      # a replay (new checkpoint) must not append again
        s = spark.readStream.schema("utt_id string, split string, duration double, text string") \
            .option("maxFilesPerTrigger", 1).json(src)
        meta = ST.stream_append(s, root, per_shard=20, first_shard=0)
    v = read_versions(spark, meta)
    assert v.count() == 3
    rows = spark.read.parquet(f"{root}/manifest").count()
    assert rows == v.agg(F.max("dataset_config.num_shards")).first()[0] * 20


def test_tar_shards_round_trip(spark):
    from voxspark.sinks import tar as T
    from voxspark.sources import shards as SS
    rows = [(0, 0, "a.wav", b"AAAA"), (0, 1, "b.wav", b"BB"), (0, 2, "a.wav", b"AAAA"), (1, 0, "c.wav", b"C" * 1000)]
    df = spark.createDataFrame(rows, "shard_id int, pos long, member string, content binary")
    path = scratch_path(spark, "tars")
    T.write_tar_shards(df, path)
    back = sorted((r.shard_id, r.member, bytes(r.content)) for r in SS.read_shards(spark, path, with_content=True).collect())
    assert back == [(0, "a.wav", b"AAAA"), (0, "b.wav", b"BB"), (1, "c.wav", b"C" * 1000)]


def test_corpus_stats_query_gives_no_task_a_manifest(spark, tmp_path, monkeypatch):
    from voxspark.plans import q_manifest as Q
    texts = [None, "", " a ", "a", "б"] + [f"text {i}" for i in range(25)]
    for name, parts in (("documents", 6), ("conversations", 4), ("benchmark", 5)):
        for i in range(parts):
            rows = [(t if name != "benchmark" else f"bad\r\n{i} {t}",) for t in texts]
            spark.createDataFrame(rows, "text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "sf" / f"{name}.parquet"))
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    s = Q.agg6_corpus_stats(spark, str(tmp_path / "sf")).first()
    # 10 files of 30 texts: 28 a file are not empty, 27 of them differ, 2 are errors beside 150 bad lines
    assert (s.processed, s.unique, s.duplicates, s.errors, s.files) == (280, 27, 253, 170, 7)
    for name in ("documents", "conversations", "bad"):
        sizes = [len(p.read_text(encoding="utf-8").splitlines()) for p in (tmp_path / "agg6" / name).rglob("part-*")]
        assert sum(sizes) == 30 * {"documents": 6, "conversations": 4, "bad": 5}[name]
        assert max(sizes) <= 30, name              # no part holds more than the rows of one input file


def test_corpus_stats_query_takes_empty_tables(spark, tmp_path):
    from voxspark.plans import q_manifest as Q
    for name in ("documents", "conversations", "benchmark"):
        spark.createDataFrame([], "text string").write.parquet(str(tmp_path / f"{name}.parquet"))
    s = Q.agg6_corpus_stats(spark, str(tmp_path)).first()
    assert (s.processed, s.unique, s.duplicates, s.errors, s.files) == (0, 0, 0, 0, 0) and s.dedup_rate is None


def test_parts_of_a_written_manifest_count_as_one_file(spark, tmp_path):
    from voxspark.operators import manifest as M
    from voxspark.sinks import manifest as K
    df = spark.range(0, 40, 1, 4).select(F.concat(F.lit("t"), (F.col("id") % 30).cast("string")).alias("text"))
    K.write_manifest(K.dealt(df, 3), str(tmp_path / "m"), partition_by=("manifest",))
    (tmp_path / "plain").mkdir()
    for n in "ab":
        (tmp_path / "plain" / f"{n}.jsonl").write_text('{"text": "t0"}\n', encoding="utf-8")
    paths = [str(tmp_path / "m"), str(tmp_path / "plain")]
    whole, parts = (M.corpus_stats(S.read_manifest_lines(spark, paths, folders=f)).first() for f in (True, False))
    assert (whole.processed, whole.unique, whole.files) == (42, 30, 3 + 2)
    assert (parts.processed, parts.unique, parts.files) == (42, 30, 4 * 3 + 2)
    per = [r["count"] for r in S.read_manifest_lines(spark, paths[0], folders=True).groupBy("manifest").count().collect()]
    assert sorted(per) == [13, 13, 14]
