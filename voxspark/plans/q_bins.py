"""Queries: duration / token bins, bucket assignment, outliers, batch plans
(WIN9-WIN14, JOIN6, FLT7, FLT8, AGG8, AGG9, PRJ13, SCL16, SCL17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bins as B
from . import views as V
from .registry import query, r6

MANIFEST = V.with_views("v_manifest")
TOKENS = V.with_views("v_tokens")
NB1 = 30             # 1-D buckets
NB2, NSUB = 16, 4    # 2-D buckets x sub-buckets
THR = 4.0


def _recursive(with_clause: str) -> str:
    return with_clause.replace("WITH ", "WITH RECURSIVE ", 1)


# ---------------------------------------------------------------- 1-D (WIN9)
WALK_1D = f"""{_recursive(MANIFEST)},
s AS (SELECT duration AS d, row_number() OVER (ORDER BY duration) AS rn FROM v_manifest),
p AS (SELECT sum(d) / {NB1} AS share FROM s),
w(rn, d, tot, b) AS (
  SELECT rn, d, d, 0 FROM s WHERE rn = 1
  UNION ALL
  SELECT s.rn, s.d,
         CASE WHEN w.tot > (SELECT share FROM p) THEN s.d ELSE w.tot + s.d END,
         CASE WHEN w.tot > (SELECT share FROM p) THEN w.b + 1 ELSE w.b END
  FROM w JOIN s ON s.rn = w.rn + 1),
bounds AS (SELECT b - 1 AS bin_id, min_by(d, rn) AS bound FROM w WHERE b > 0 GROUP BY b),
xb AS (SELECT bin_id, bound FROM bounds
       UNION ALL SELECT (SELECT count(*) FROM bounds), (SELECT max(d) FROM s))"""


def _bins_1d(spark, sf):
    return B.duration_bins(V.v_manifest(spark, sf), NB1)


@query("win9_duration_bins", covers=("WIN9",),
       sql=f"{WALK_1D}\nSELECT CAST(bin_id AS INTEGER) AS bin_id, bound FROM bounds")
def win9_duration_bins(spark, sf):
    b = _bins_1d(spark, sf)
    return spark.createDataFrame(list(enumerate(b)), "bin_id int, bound double")


def _bounds_1d(spark, sf):
    """WIN9 bins plus the longest duration as the closed last bound."""
    m = V.v_manifest(spark, sf)
    return _bins_1d(spark, sf) + [m.agg(F.max("duration")).first()[0]]


ASSIGN_1D = """CASE WHEN (SELECT count(*) FROM xb x WHERE x.bound <= m.duration) < (SELECT count(*) FROM xb)
            THEN (SELECT count(*) FROM xb x WHERE x.bound <= m.duration)
            WHEN m.duration = (SELECT max(bound) FROM xb) THEN (SELECT count(*) FROM xb) - 1 END"""


@query("join6_assign_bin_1d", covers=("JOIN6",),
       sql=f"""{WALK_1D}
SELECT utt_id, CAST({ASSIGN_1D} AS INTEGER) AS bin_id FROM v_manifest m""")
def join6_assign_bin_1d(spark, sf):
    return B.assign_bin_1d(V.v_manifest(spark, sf), _bounds_1d(spark, sf)).select("utt_id", "bin_id")


def _batch_sizes(n: int) -> list[int]:
    """Batch size per 1-D bin: a fixed, decreasing rule (long bins get small batches)."""
    return [max(1, 16 >> (i // 8)) for i in range(n)]


@query("win12_plan_batches", covers=("WIN12",),
       sql=f"""{WALK_1D},
a AS (SELECT utt_id, duration, {ASSIGN_1D} AS bin_id FROM v_manifest m),
q AS (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY duration, utt_id) - 1 AS pos_in_bin
      FROM a WHERE bin_id IS NOT NULL)
SELECT utt_id, CAST(bin_id AS INTEGER) AS bin_id, pos_in_bin,
       CAST(floor(pos_in_bin / greatest(1, 16 >> CAST(bin_id // 8 AS INTEGER))) AS BIGINT) AS batch
FROM q""")
def win12_plan_batches(spark, sf):
    b = _bounds_1d(spark, sf)
    a = B.assign_bin_1d(V.v_manifest(spark, sf), b)
    p = B.plan_batches(a, _batch_sizes(len(b)), ["duration", "utt_id"])
    return p.select("utt_id", "bin_id", "pos_in_bin", "batch")


CAP, QUAD = 1200.0, 600.0


@query("win13_capped_batches", covers=("WIN13",),
       sql=f"""{WALK_1D},
a AS (SELECT utt_id, duration, {ASSIGN_1D} AS bin_id FROM v_manifest m),
q AS (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY duration, utt_id) - 1 AS pos_in_bin,
             duration + duration * duration / {QUAD} AS eff
      FROM a WHERE bin_id IS NOT NULL),
cb(bin_id, pos_in_bin, tot, batch) AS (
  SELECT bin_id, pos_in_bin, eff, 0 FROM q WHERE pos_in_bin = 0
  UNION ALL
  SELECT q.bin_id, q.pos_in_bin,
         CASE WHEN cb.tot > 0 AND cb.tot + q.eff > {CAP} THEN q.eff ELSE cb.tot + q.eff END,
         CASE WHEN cb.tot > 0 AND cb.tot + q.eff > {CAP} THEN cb.batch + 1 ELSE cb.batch END
  FROM cb JOIN q ON q.bin_id = cb.bin_id AND q.pos_in_bin = cb.pos_in_bin + 1)
SELECT q.utt_id, CAST(q.bin_id AS INTEGER) AS bin_id, q.pos_in_bin, CAST(cb.batch AS BIGINT) AS batch
FROM q JOIN cb ON q.bin_id = cb.bin_id AND q.pos_in_bin = cb.pos_in_bin""")
def win13_capped_batches(spark, sf):
    b = _bounds_1d(spark, sf)
    a = B.assign_bin_1d(V.v_manifest(spark, sf), b)
    # chunks that the bins of sf0.01 already run over; the batches do not depend on them
    return B.plan_batches_capped(a, CAP, QUAD, buffer=64).select("utt_id", "bin_id", "pos_in_bin", "batch")


@query("win14_merge_bins", covers=("WIN14",),
       sql=f"""{WALK_1D},
prof AS (SELECT bound, greatest(1, CAST(floor(6000.0 / bound) AS INTEGER) // 4 * 4) AS batch_size FROM bounds),
l AS (SELECT *, CASE WHEN lag(batch_size) OVER (ORDER BY bound) = batch_size THEN 0 ELSE 1 END AS new FROM prof),
g AS (SELECT *, sum(new) OVER (ORDER BY bound ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM l)
SELECT max(bound) AS bound, min(batch_size) AS batch_size FROM g GROUP BY grp""")
def win14_merge_bins(spark, sf):
    b = _bins_1d(spark, sf)
    prof = spark.createDataFrame([(x,) for x in b], "bound double").withColumn(
        "batch_size", F.greatest(F.lit(1), (F.floor(F.lit(6000.0) / F.col("bound")).cast("int") / 4).cast("int") * 4))
    return B.merge_bins(prof)


@query("agg8_describe_duration", covers=("AGG8",),
       sql=f"""{MANIFEST}
SELECT count(duration) AS count, round(avg(duration), 6) AS mean, round(stddev_samp(duration), 6) AS std,
       min(duration) AS min,
       {', '.join(f"round(quantile_cont(duration, {p}), 6) AS {n}" for p, n in [(0.01, 'p01'), (0.05, 'p05'), (0.1, 'p10'), (0.25, 'p25'), (0.5, 'p50'), (0.75, 'p75'), (0.9, 'p90'), (0.95, 'p95'), (0.99, 'p99'), (0.995, 'p995'), (0.999, 'p999')])},
       max(duration) AS max
FROM v_manifest""")
def agg8_describe_duration(spark, sf):
    d = B.describe_duration(V.v_manifest(spark, sf))
    return d.select(*[r6(c).alias(c) if c not in ("count", "min", "max") else F.col(c) for c in d.columns])


@query("win11_static_buckets", covers=("WIN11",),
       sql=f"""{MANIFEST},
lim AS (SELECT min(duration) AS lo, max(duration) AS hi FROM v_manifest),
r AS (SELECT i, lo + i * ((hi - lo) / 5.0) AS a,
             lo + i * ((hi - lo) / 5.0) + ((hi - lo) / 5.0) + CASE WHEN i = 4 THEN 1e-5 ELSE 0 END AS b
      FROM lim, range(5) t(i))
SELECT m.utt_id, CAST((SELECT min(i) FROM r WHERE m.duration >= r.a AND m.duration < r.b) AS INTEGER) AS bucket
FROM v_manifest m""")
def win11_static_buckets(spark, sf):
    """One manifest folder per static bucket (``bucket=<i>/``), read back: a reader of
    one bucket prunes the others by path."""
    from ..session import scratch_path
    from ..sinks.manifest import write_manifest
    m = V.v_manifest(spark, sf)
    lo, hi = m.agg(F.min("duration"), F.max("duration")).first()
    b = B.assign_static_bucket(m, B.static_buckets(lo, hi, 5))
    root = scratch_path(spark, "buckets")
    write_manifest(b.select("utt_id", "duration", "text", "bucket"), root, partition_by=("bucket",))
    return spark.read.schema("utt_id string, duration double, text string, bucket int").json(root) \
        .select("utt_id", "bucket")


# ---------------------------------------------------------------- 2-D (WIN10)
WALK_2D = f"""{_recursive(TOKENS)},
s AS (SELECT utt_id, duration AS d, CAST(tokens AS BIGINT) AS t,
             row_number() OVER (ORDER BY duration, tokens, utt_id) AS rn FROM v_tokens),
p AS (SELECT sum(d) / {NB2} AS share, max(d) AS dmax FROM s),
w(rn, tot, b) AS (
  SELECT 1, (SELECT d FROM s WHERE rn = 1), 0
  UNION ALL
  SELECT s.rn,
         CASE WHEN w.tot > (SELECT share FROM p) THEN s.d ELSE w.tot + s.d END,
         CASE WHEN w.tot > (SELECT share FROM p) THEN w.b + 1 ELSE w.b END
  FROM w JOIN s ON s.rn = w.rn + 1),
bk AS (SELECT s.*, w.b FROM s JOIN w USING (rn)),
firsts AS (SELECT b, min_by(d, rn) AS d0 FROM bk GROUP BY b),
md AS (SELECT f.b, coalesce((SELECT d0 FROM firsts n WHERE n.b = f.b + 1), (SELECT dmax FROM p)) AS maxdur
       FROM firsts f),
z AS (SELECT *, t / d AS tps, avg(t / d) OVER (PARTITION BY b) AS mu,
             stddev_pop(t / d) OVER (PARTITION BY b) AS sigma FROM bk),
tagged AS (SELECT *, (sigma = 0 OR sigma IS NULL OR (tps - mu) / sigma <= {THR}) AS keep FROM z),
stats AS (SELECT b, count(*) AS rows, min(CASE WHEN keep THEN t END) AS min_tokens,
                 max(CASE WHEN keep THEN t END) AS max_tokens, max(CASE WHEN keep THEN tps END) AS max_tps,
                 CAST(count_if(NOT keep) AS BIGINT) AS outliers, min(CASE WHEN NOT keep THEN tps END) AS min_outlier_tps,
                 max(CASE WHEN NOT keep THEN tps END) AS max_outlier_tps FROM tagged GROUP BY b),
kept AS (SELECT b, t, row_number() OVER (PARTITION BY b ORDER BY t, d, utt_id) AS rn2 FROM tagged WHERE keep),
sh AS (SELECT b, sum(t) / {NSUB} AS share FROM kept GROUP BY b),
tw(b, rn2, t, tot, sb) AS (
  SELECT b, rn2, t, t, 0 FROM kept WHERE rn2 = 1
  UNION ALL
  SELECT k.b, k.rn2, k.t,
         CASE WHEN tw.tot > (SELECT share FROM sh WHERE sh.b = tw.b) THEN k.t ELSE tw.tot + k.t END,
         CASE WHEN tw.tot > (SELECT share FROM sh WHERE sh.b = tw.b) THEN tw.sb + 1 ELSE tw.sb END
  FROM tw JOIN kept k ON k.b = tw.b AND k.rn2 = tw.rn2 + 1),
ends AS (SELECT b, sb - 1 AS j, min_by(t, rn2) AS max_tokens FROM tw WHERE sb > 0 GROUP BY b, sb
         UNION ALL
         SELECT b, max(sb) AS j, max_by(t, rn2) AS max_tokens FROM tw GROUP BY b),
bins AS (SELECT CAST(row_number() OVER (ORDER BY e.b, e.j) - 1 AS INTEGER) AS bin_id, CAST(e.b AS INTEGER) AS bucket,
                md.maxdur AS max_duration, CAST(e.max_tokens AS BIGINT) AS max_tokens, st.max_tps
         FROM ends e JOIN md ON md.b = e.b JOIN stats st ON st.b = e.b)"""


def _bins_2d(spark, sf):
    return B.duration_bins_2d(V.v_tokens(spark, sf), NB2, NSUB, THR)


@query("win10_bins_2d", covers=("WIN10", "H-1"),
       sql=f"""{WALK_2D}
SELECT bin_id, bucket, max_duration, max_tokens, round(max_tps, 6) AS max_tps FROM bins""")
def win10_bins_2d(spark, sf):
    bins, _ = _bins_2d(spark, sf)
    return bins.withColumn("max_tps", r6("max_tps"))


@query("agg9_bucket_stats", covers=("AGG9", "FLT7"),
       sql=f"""{WALK_2D}
SELECT CAST(b AS INTEGER) AS bucket, rows, min_tokens, max_tokens, round(max_tps, 6) AS max_tps, outliers,
       round(min_outlier_tps, 6) AS min_outlier_tps, round(max_outlier_tps, 6) AS max_outlier_tps FROM stats""")
def agg9_bucket_stats(spark, sf):
    _, st = _bins_2d(spark, sf)
    return st.select("bucket", F.col("rows").cast("long").alias("rows"), "min_tokens", "max_tokens",
                     r6("max_tps").alias("max_tps"), F.col("outliers").cast("long").alias("outliers"),
                     r6("min_outlier_tps").alias("min_outlier_tps"), r6("max_outlier_tps").alias("max_outlier_tps"))


def _bin_list(bins_df):
    rows = bins_df.orderBy("bin_id").collect()        # buckets x sub-buckets rows
    return [(r.max_duration, r.max_tokens) for r in rows], [r.max_tps for r in rows]


@query("join6_assign_bin_2d", covers=("JOIN6", "FLT8", "PRJ14"),
       sql=f"""{WALK_2D},
a AS (SELECT s.utt_id, s.d, s.t, (SELECT min(bin_id) FROM bins x WHERE s.d <= x.max_duration AND s.t <= x.max_tokens) AS bin_id
      FROM s)
SELECT a.utt_id, a.bin_id, a.t / a.d <= x.max_tps AS within_tps
FROM a LEFT JOIN bins x ON x.bin_id = a.bin_id""")
def join6_assign_bin_2d(spark, sf):
    bins, _ = _bins_2d(spark, sf)
    pairs, caps = _bin_list(bins)
    a = B.assign_bin_2d(V.v_tokens(spark, sf), pairs)
    return a.select("utt_id", "bin_id", B.within_tps(caps).alias("within_tps"))


@query("scl17_format_bins", covers=("SCL17", "SCL16", "PRJ13"),
       sql=f"""{WALK_2D},
f AS (SELECT '[' || string_agg(printf('[%.3f,%d]', max_duration, max_tokens), ',' ORDER BY bin_id) || ']' AS bins,
             '[' || string_agg(printf('%.2f', max_tps), ',' ORDER BY bin_id) || ']' AS max_tps,
             CAST(sum(CAST(round_even(max_duration * 16000, 0) AS BIGINT)) AS BIGINT) AS total_input_samples FROM bins)
SELECT bins, max_tps, total_input_samples, true AS is_2d,
       CAST(len(CAST(bins AS DOUBLE[][])) AS INTEGER) AS n_bins FROM f""")
def scl17_format_bins(spark, sf):
    bins, _ = _bins_2d(spark, sf)
    f = B.format_bins(B.bin_limits(bins), F.sum("input_samples").alias("total_input_samples"))
    parsed = f.withColumn("_p", B.parse_bins(F.col("bins")))
    return parsed.select("bins", "max_tps", "total_input_samples", F.col("_p.is_2d").alias("is_2d"),
                         F.size("_p.bins").alias("n_bins"))
