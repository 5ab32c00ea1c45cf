"""Bins against the sequential rule (WIN9-WIN14, FLT7, JOIN6)."""
import random

from pyspark.sql import functions as F

import brute
from voxspark.operators import bins as B


def test_bins_2d_worked_example(spark):
    df = spark.createDataFrame([(1.0, 2), (1.0, 3), (2.0, 4), (2.0, 5), (3.0, 6), (3.0, 7), (4.0, 8), (4.0, 9)],
                               "duration double, tokens long")
    bins, _ = B.duration_bins_2d(df, 2, 2)
    got = [(r.max_duration, r.max_tokens, r.max_tps) for r in bins.orderBy("bin_id").collect()]
    assert got == [(4.0, 6, 3.0), (4.0, 7, 3.0), (4.0, 9, 2.25)]


def test_bins_match_sequential_rule(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(600):
        d = rnd.randint(1, 400) / 16.0          # repeated, binary-exact lengths
        rows.append((d, max(0, int(d * rnd.uniform(0.5, 4)) + (200 if rnd.random() < 0.01 else 0))))
    df = spark.createDataFrame(rows, "duration double, tokens long")
    for nb, m in [(5, 3), (12, 2)]:
        bins, _ = B.duration_bins_2d(df, nb, m)
        got = [(r.max_duration, r.max_tokens, round(r.max_tps, 9)) for r in bins.orderBy("bin_id").collect()]
        eb, ec = brute.bins_2d([r[0] for r in rows], [r[1] for r in rows], nb, m)
        assert got == [(float(x[0]), x[1], round(float(c), 9)) for x, c in zip(eb, ec)]
    assert B.duration_bins(df, 7) == brute.bins_1d([r[0] for r in rows], 7)


def test_boundaries_of_any_weights(spark):
    """Light, heavy, zero, equal and growing weights: the plain walk's boundaries, whatever the
    number of bins."""
    rnd = random.Random(11)
    made = [[rnd.choice([0.0, 0.125, 1.0, 7.5, 64.0]) for _ in range(300)], [2.0 ** -k for k in range(40)] * 2, [1.0] * 97,
            [rnd.randint(1, 10 ** 6) / 1024 for _ in range(500)], [0.0] * 5, [3.0], [0.5] * 200 + [1000.0] * 3]
    for lengths in made:
        df = spark.createDataFrame([(x,) for x in lengths], "duration double")
        for n in (2, 7, 30):
            assert B.duration_bins(df, n) == (brute.bins_1d(lengths, n) if sum(lengths) else [])
    assert B.duration_bins(spark.createDataFrame([], "duration double"), 4) == []


def test_boundary_summary_is_small(spark):
    """A summary holds about K * K cells at most, far less than the lengths there are."""
    cells = B._cells(spark.range(200_000).select(((F.col("id") * 7919) % 100_000 / 64.0 + 1).alias("d")), ["d"], "d")
    total = cells.agg(F.sum(F.col("d") * F.col("c"))).first()[0]
    walk = cells.withColumn("g", F.lit(0)).withColumn("share", F.lit(total / 30))
    plan = B.resetting_boundaries(walk, "g", "d", "d", 31)
    kept = _near_cells(walk, 31)
    assert kept <= 2 * 31 * 31 < cells.count() / 20
    assert len(plan.first().found) in (29, 30)


def _near_cells(walk, bins):
    low = F.greatest(F.ceil(F.col("P0") / (F.col("share") + F.col("d")) * (1 - 1e-9)), F.lit(1))
    high = F.least(F.floor((F.col("P0") + F.col("c") * F.col("d")) / F.col("share") * (1 + 1e-9)), F.lit(bins))
    return walk.where(low <= high).count()


def test_assign_1d_last_closed(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (3.0,), (3.5,)], "duration double")
    got = [r.bin_id for r in B.assign_bin_1d(df, [1.0, 2.0, 3.0]).orderBy("duration").collect()]
    assert got == [0, 1, 2, 2, None]


def test_merge_bins(spark):
    prof = spark.createDataFrame([(5.0, 64), (10.0, 32), (15.0, 32), (20.0, 16)], "bound double, batch_size int")
    got = sorted((r.bound, r.batch_size) for r in B.merge_bins(prof).collect())
    assert got == [(5.0, 64), (15.0, 32), (20.0, 16)]


def test_static_buckets_admit_max():
    r = B.static_buckets(0.0, 10.0, 4)
    assert r[0][0] == 0.0 and r[-1][1] > 10.0 and len(r) == 4


def test_zero_length_rows_are_outliers(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(1, 200) / 16.0, rnd.randint(0, 60)) for _ in range(400)]
    df = spark.createDataFrame(rows + [(0.0, 3), (0.0, 0)], "duration double, tokens long")
    bins, stats = B.duration_bins_2d(df, 6, 3)
    assert all(r.max_tps < 1e9 for r in bins.collect())
    first = stats.filter("bucket = 0").first()
    assert first.outliers >= 2 and first.max_outlier_tps == float("inf")


def test_describe_duration(spark):
    import numpy as np
    v = [1.0, 2.0, 2.0, 3.5, 10.0, 11.25, 40.0]
    got = B.describe_duration(spark.createDataFrame([(x,) for x in v] + [(None,)], "duration double")).first()
    assert (got["count"], got["min"], got["max"]) == (7, 1.0, 40.0)
    assert abs(got["mean"] - np.mean(v)) < 1e-9 and abs(got["std"] - np.std(v, ddof=1)) < 1e-9
    for name, p in B.PERCENTILES.items():
        assert abs(got[name] - np.quantile(v, p)) < 1e-9
    none = B.describe_duration(spark.createDataFrame([], "duration double")).first()
    assert none["count"] == 0 and none["p50"] is None and none["std"] is None


def test_parse_bins_and_limits(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("[[2.5, 18], [20.0, 174]]",), ("[5.0, 10.0, 15.5]",)], "s string")
    got = [(r.p.is_2d, r.p.bins) for r in df.select(B.parse_bins(F.col("s")).alias("p")).collect()]
    assert got == [(True, [[2.5, 18.0], [20.0, 174.0]]), (False, [[5.0], [10.0], [15.5]])]
    one = spark.createDataFrame([(0, 5.0), (1, 15.5)], "bin_id int, max_duration double")
    lim = [(r.input_samples, r.output_len) for r in B.bin_limits(one).orderBy("bin_id").collect()]
    assert lim == [(80000, 60), (248000, 186)]


def test_capped_batches_stay_open_over_chunk_edges(spark):
    """The same batches for every buffer, those of one sequential fill."""
    rnd = random.Random(8)
    rows = [(i, b, rnd.choice([0.0, 0.0, 3.0, 3.0, 7.1, rnd.uniform(0, 40), 500.0 if rnd.random() < 0.05 else 1.3]))
            for b, n in ((0, 400), (1, 63), (2, 1)) for i in range(1000 * b, 1000 * b + n)]
    df = spark.createDataFrame(rows, "utt_id long, bin_id int, duration double")
    for order in (["utt_id"], ["duration", "utt_id"]):
        want = {}
        for b in range(3):
            tot = n = 0
            for i, _, d in sorted((r for r in rows if r[1] == b), key=lambda r: (r[2], r[0]) if len(order) == 2 else r[0]):
                e = d + d * d / 60.0
                if tot > 0 and tot + e > 120.0:
                    tot, n = 0, n + 1
                tot += e
                want[i] = n
        for buffer, fan in ((1, 3), (3, 64), (50, 2), (20000, 64)):
            got = B.plan_batches_capped(df, cap=120.0, quadratic=60.0, buffer=buffer, order=order, fan=fan).collect()
            assert {r.utt_id: r.batch for r in got} == want
