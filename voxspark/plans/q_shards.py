"""Queries: shuffles, shards, order in shard, repeats, latest row, shard metadata,
limits (WIN1-WIN8, AGG10-AGG11, SNK4, SNK6, LIM1-LIM2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shards as H
from ..session import scratch_path
from ..sinks import shards as KS
from ..sources import manifest as S
from . import views as V
from .registry import query

MANIFEST = V.with_views("v_manifest")
REPEATS = V.with_views("v_repeats")
SEED = 42


def _shuffled_sql(view: str, extra: str = "") -> str:
    return (f"SELECT *{extra}, row_number() OVER (ORDER BY md5('{SEED}' || utt_id), utt_id) - 1 AS idx "
            f"FROM {view}")


@query("win7_shuffle", covers=("WIN7",),
       sql=f"""{MANIFEST}
SELECT utt_id, idx FROM ({_shuffled_sql('v_manifest')})""")
def win7_shuffle(spark, sf):
    from ..operators.index import with_index
    m = V.v_manifest(spark, sf)
    return with_index(m, H.shuffle_key(SEED)).select("utt_id", "idx")


def _even_sql(view: str, shards: int) -> str:
    return f"""s AS ({_shuffled_sql(view)}), n AS (SELECT count(*) // {shards} AS k FROM v_manifest)
SELECT utt_id, CASE WHEN idx < k * {shards} THEN CAST(idx // k AS INTEGER) END AS shard_id
FROM s, n"""


@query("win1_shard_even", covers=("WIN1", "SET4"),
       sql=f"""{MANIFEST},
{_even_sql('v_manifest', 7)}""")
def win1_shard_even(spark, sf):
    kept, dropped = H.shard_even(V.v_manifest(spark, sf), 7, H.shuffle_key(SEED))
    return (kept.select("utt_id", "shard_id")
            .unionByName(dropped.select("utt_id", F.lit(None).cast("int").alias("shard_id"))))


@query("win2_shard_append", covers=("WIN2", "SET2"),
       sql=f"""{MANIFEST},
base AS (SELECT count(*) // 10 AS per FROM v_manifest WHERE split = 'train'),
s AS (SELECT utt_id, row_number() OVER (ORDER BY md5('{SEED}' || utt_id), utt_id) - 1 AS idx
      FROM v_manifest WHERE split <> 'train'),
m AS (SELECT count(*) AS n FROM s)
SELECT utt_id, CASE WHEN idx < (n // per) * per THEN CAST(10 + idx // per AS INTEGER) END AS shard_id
FROM s, base, m""")
def win2_shard_append(spark, sf):
    m = V.v_manifest(spark, sf)
    base = m.filter(F.col("split") == "train")
    per = int(H.shard_plan(base, 10).first()["samples_per_shard"])   # from base metadata
    new = m.filter(F.col("split") != "train")
    kept, dropped = H.shard_append(new, per, 10, H.shuffle_key(SEED))
    return (kept.select("utt_id", "shard_id")
            .unionByName(dropped.select("utt_id", F.lit(None).cast("int").alias("shard_id"))))


@query("win3_shard_fixed", covers=("WIN3",),
       sql=f"""{MANIFEST}
SELECT utt_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 37 AS INTEGER) AS shard_id
FROM v_manifest""")
def win3_shard_fixed(spark, sf):
    m = V.v_manifest(spark, sf, keep_doc_id=True)
    return H.shard_fixed(m, 37, ["doc_id"]).select("utt_id", "shard_id")


def _in_shard_sql(view: str, shards: int) -> str:
    return f"""s AS ({_shuffled_sql(view)}), n AS (SELECT count(*) // {shards} AS k FROM {view}),
sh AS (SELECT s.*, CAST(idx // k AS INTEGER) AS shard_id FROM s, n WHERE idx < k * {shards}),
p AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY duration, idx) - 1 AS pos FROM sh)"""


@query("win4_order_in_shard", covers=("WIN4",),
       sql=f"""{MANIFEST},
{_in_shard_sql('v_manifest', 7)}
SELECT utt_id, shard_id, pos FROM p""")
def win4_order_in_shard(spark, sf):
    kept, _ = H.shard_even(V.v_manifest(spark, sf), 7, H.shuffle_key(SEED))
    return H.order_in_shard(kept).select("utt_id", "shard_id", "pos")


REPEAT_SQL = f"""{REPEATS},
{_in_shard_sql('v_repeats', 4)},
q AS (SELECT *, replace(replace(regexp_replace(audio_filepath, '\\.wav$', ''), '/', '_'), '.', '_') AS b FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY shard_id, b ORDER BY pos) - 1 AS rep FROM q)"""


@query("win5_number_repeats", covers=("WIN5", "PRJ8", "PRJ9"),
       sql=f"""{REPEAT_SQL}
SELECT utt_id, shard_id, pos, CASE WHEN rep = 0 THEN b || '.wav' ELSE b || '-sub' || CAST(rep AS VARCHAR) || '.wav' END AS member
FROM r""")
def win5_number_repeats(spark, sf):
    kept, _ = H.shard_even(V.v_repeats(spark, sf), 4, H.shuffle_key(SEED))
    rep = H.number_repeats(H.order_in_shard(kept))
    return rep.select("utt_id", "shard_id", "pos", "member")


@query("win6_latest", covers=("WIN6",),
       sql=f"""{MANIFEST},
u AS (SELECT utt_id, text, 1 AS version FROM v_manifest
      UNION ALL SELECT utt_id, text || ' [v2]', 2 FROM v_manifest WHERE split = 'train')
SELECT utt_id, max_by(text, version) AS text, max(version) AS version FROM u GROUP BY utt_id""")
def win6_latest(spark, sf):
    m = V.v_manifest(spark, sf)
    v1 = m.select("utt_id", "text", F.lit(1).alias("version"))
    v2 = m.filter(F.col("split") == "train").select("utt_id", F.concat("text", F.lit(" [v2]")).alias("text"),
                                                    F.lit(2).alias("version"))
    return H.latest(v1.unionByName(v2), "utt_id", "version").select("utt_id", "text", "version")


@query("win8_shuffle_by_file", covers=("WIN8",),
       sql=f"""{REPEATS}
SELECT utt_id, row_number() OVER (ORDER BY md5('{SEED}' || audio_filepath), audio_filepath, doc_id) - 1 AS idx
FROM v_repeats""")
def win8_shuffle_by_file(spark, sf):
    from ..operators.index import with_index
    r = V.v_repeats(spark, sf).withColumnRenamed("doc_id", "input_idx")
    return with_index(r, H.file_shuffle_key(SEED)).select("utt_id", "idx")


@query("agg10_shard_stats", covers=("AGG10",),
       sql=f"""{REPEATS},
{_in_shard_sql('v_repeats', 4)}
SELECT shard_id, count(*) AS rows, count(DISTINCT audio_filepath) AS files FROM p GROUP BY shard_id""")
def agg10_shard_stats(spark, sf):
    kept, _ = H.shard_even(V.v_repeats(spark, sf), 4, H.shuffle_key(SEED))
    return H.shard_stats(kept)


@query("agg11_shard_plan", covers=("AGG11",),
       sql=f"""{MANIFEST}
SELECT count(*) AS n, 7 AS num_shards, count(*) // 7 AS samples_per_shard, count(*) % 7 AS remainder
FROM v_manifest""")
def agg11_shard_plan(spark, sf):
    return H.shard_plan(V.v_manifest(spark, sf), 7)


@query("snk4_write_shards", covers=("SNK4", "SRC10", "PRJ9"),
       sql=f"""{REPEAT_SQL}
SELECT utt_id, shard_id, CASE WHEN rep = 0 THEN b || '.wav' ELSE b || '-sub' || CAST(rep AS VARCHAR) || '.wav' END AS audio_filepath,
       duration, text
FROM r""")
def snk4_write_shards(spark, sf):
    kept, _ = H.shard_even(V.v_repeats(spark, sf), 4, H.shuffle_key(SEED))
    rep = H.number_repeats(H.order_in_shard(kept)).drop("idx", "doc_id")
    root = scratch_path(spark, "tarred")
    KS.write_shards(rep, root)
    back = S.read_manifest(spark, f"{root}/sharded_manifests")   # metadata only (SRC10)
    return back.select("utt_id", "shard_id", "audio_filepath", "duration", "text")


@query("snk6_metadata_versions", covers=("SNK6", "AGG11"),
       sql=f"""{MANIFEST},
c AS (SELECT CAST(count_if(split = 'train') // 10 AS INTEGER) AS per, count_if(split <> 'train') AS m FROM v_manifest)
SELECT 0 AS version, CAST(NULL AS INTEGER) AS num_samples_per_shard, false AS is_concatenated_manifest,
       -1 AS num_shards, 0 AS n_history, false AS shuffle, true AS sort_in_shards, CAST(NULL AS INTEGER) AS shuffle_seed FROM c
UNION ALL
SELECT 1, per, false, 10, 0, true, true, {SEED} FROM c
UNION ALL
SELECT 2, per, true, CAST(10 + m // per AS INTEGER), 1, true, true, {SEED} FROM c""")
def snk6_metadata_versions(spark, sf):
    """The blank record, then two versions of a data set."""
    m = V.v_manifest(spark, sf)
    path = scratch_path(spark, "metadata")
    base_plan = H.shard_plan(m.filter(F.col("split") == "train"), 10).first()
    per = int(base_plan["samples_per_shard"])
    KS.append_version(spark, path, {"num_shards": 10, "shuffle": True, "shuffle_seed": SEED},
                      per, False)
    new_rows = H.shard_plan(m.filter(F.col("split") != "train"), 1).first()["n"]
    meta = KS.append_version(spark, path, {"num_shards": 10 + int(new_rows) // per,
                                           "shuffle": True, "shuffle_seed": SEED}, per, True)
    return KS.default_record(spark).unionByName(meta).select(
        "version", "num_samples_per_shard", "is_concatenated_manifest", F.col("dataset_config.num_shards").alias("num_shards"),
        F.size("history").alias("n_history"), F.col("dataset_config.shuffle").alias("shuffle"),
        F.col("dataset_config.sort_in_shards").alias("sort_in_shards"), F.col("dataset_config.shuffle_seed").alias("shuffle_seed"))


@query("scl19_stamp", covers=("SCL19",),
       sql="SELECT event_id, strftime(ts, '%m-%d-%Y %H-%M-%S') AS stamp FROM events")
def scl19_stamp(spark, sf):
    return V.table(spark, sf, "events").select("event_id", KS.stamp(F.col("ts")).alias("stamp"))


@query("lim1_first_n", covers=("LIM1",),
       sql=f"""{MANIFEST}
SELECT utt_id, duration FROM v_manifest ORDER BY duration DESC, utt_id LIMIT 25""")
def lim1_first_n(spark, sf):
    m = V.v_manifest(spark, sf)
    return H.take_first(m, 25, [F.col("duration").desc(), F.col("utt_id")]).select("utt_id", "duration")


@query("lim2_sample_n", covers=("LIM2",),
       sql=f"""{MANIFEST}
SELECT utt_id FROM v_manifest ORDER BY md5('7' || utt_id), utt_id LIMIT 50""")
def lim2_sample_n(spark, sf):
    return H.sample_n(V.v_manifest(spark, sf), 50, 7).select("utt_id")
