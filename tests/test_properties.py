"""Counting and batching properties."""
from pyspark.sql import functions as F

from conftest import SF
from voxspark.operators import bins as B
from voxspark.operators import manifest as M
from voxspark.plans import views as V


def test_union_and_dedup_counts_add_up(spark):
    m = V.v_manifest(spark, SF)
    parts = [m.filter(F.col("split") == s) for s in ("train", "validate", "test")]
    assert M.combine(parts).count() == m.count()
    # the distinct corpus of a manifest unioned with itself is the corpus of the manifest
    assert M.corpus([m, m]).count() == M.corpus([m]).count() <= m.count()
    counts = M.manifest_counts(m).collect()
    total = [r["rows"] for r in counts if r.split is None][0]
    per_split = sum(r["rows"] for r in counts if r.split is not None and r.dataset is None)
    assert total == per_split == m.count()


def test_capped_batches_respect_cap_in_chunks(spark):
    m = V.v_manifest(spark, SF).withColumn("duration", F.col("duration") / 10)
    bounds = B.duration_bins(m, 4) + [m.agg(F.max("duration")).first()[0]]
    a = B.assign_bin_1d(m, bounds)
    p = B.plan_batches_capped(a, cap=120.0, quadratic=60.0, buffer=7)
    eff = F.col("duration") + F.col("duration") * F.col("duration") / 60.0
    sums = p.groupBy("bin_id", "chunk", "batch_in_chunk").agg(F.sum(eff).alias("s"), F.count(F.lit(1)).alias("n"))
    assert sums.filter((F.col("s") > 120.0) & (F.col("n") > 1)).count() == 0
    assert p.count() == a.filter(F.col("bin_id").isNotNull()).count()
    assert p.groupBy("bin_id", "chunk").count().agg(F.max("count")).first()[0] <= 7


def test_describe_approx_close_to_exact(spark):
    m = V.v_manifest(spark, SF)
    ex = B.describe_duration(m).first()
    ap = B.describe_duration(m, exact=False).first()
    assert ex["count"] == ap["count"] and ex["min"] == ap["min"] and ex["max"] == ap["max"]
    assert abs(ex["p50"] - ap["p50"]) <= 0.05 * ex["p50"] + 1


def test_path_helpers_match_os_path(spark):
    import os
    from voxspark.operators.manifest import squash
    from voxspark.sources.manifest import audio_segments, replace_ext
    paths = ["a/b/c.mp3", "a/b.c/d.e.flac", "x/.hidden", "clips/src0/12.wav", "noext",
             "/cache/extracted/abc123/ru/1.mp3", "d/extracted/h/x/y.z.opus", "a..b/c..mp3"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select("p", replace_ext(F.col("p")).alias("w"), squash(F.col("p")).alias("s"),
                    F.array_join(audio_segments(F.col("p")), "/").alias("g")).collect()

    def squash_py(p):
        base, ext = os.path.splitext(p)
        return base.replace("/", "_").replace(".", "_") + ext

    def segs_py(p):
        seg = [x for x in p.split("/") if x]
        if "extracted" in seg:
            seg = seg[seg.index("extracted") + 2:]
        return "/".join(seg)

    for r in got:
        assert r.w == os.path.splitext(r.p)[0] + ".wav", r.p
        assert r.s == squash_py(r.p), r.p
        assert r.g == segs_py(r.p), r.p


def test_corpus_stats_match_plain_counting(spark, tmp_path):
    import json
    import random
    from voxspark.sources import manifest as S
    rnd = random.Random(4)
    pool = ['{"text": "a"}', '{"text": " a "}', '{"text": "b"}', '{"text": ""}', '{"text": "  "}',
            '{"text": null}', '{"text": 5}', '{"other": 1}', '{}', '[1, 2]', 'not json', '{"text": "c",',
            '', '   ', '{"text": "d", "k": [1]}']
    lines = [rnd.choice(pool) for _ in range(400)]
    p = tmp_path / "c.jsonl"
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    proc = dup = err = 0
    seen = set()
    for line in lines:
        if not line.strip():
            continue
        try:
            d = json.loads(line)
        except json.JSONDecodeError:
            err += 1
            continue
        if isinstance(d, dict) and "text" in d and d["text"]:
            if not isinstance(d["text"], str):       # D-11: non-string text is an error
                err += 1
                continue
            t = d["text"].strip()
            proc += 1
            dup += t in seen
            seen.add(t)
        else:
            err += 1
    s = M.corpus_stats(S.read_manifest_lines(spark, str(p))).first()
    assert (s.processed, s.unique, s.duplicates, s.errors) == (proc, len(seen), dup, err)
