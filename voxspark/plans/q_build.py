"""Queries: the sharder as one job, from manifest and audio to a versioned data set, read back; a subset
of it exported (SNK4-SNK6, SRC9, WIN1-WIN5, JOIN2, PRJ10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import build as BD
from ..sinks import shards as KS
from ..sources import shards as SS
from . import views as V
from .q_joins import _keep2
from .registry import query

CONFIG = {"num_shards": 7, "shuffle": True, "shuffle_seed": 42, "max_duration": 1000.0}

#: Shards of the train split and of those that the other splits append, and the rows of each.
BUILT = f"""{V.with_views('v_repeats', 'v_shared_audio')},
ok AS (SELECT *, doc_id % 50 AS k, row_number() OVER (PARTITION BY split = 'train' ORDER BY md5('42' || utt_id), utt_id) - 1 AS idx
       FROM v_repeats WHERE duration < {CONFIG['max_duration']}),
n AS (SELECT count(*) FILTER (split = 'train') // {CONFIG['num_shards']} AS per, count(*) FILTER (split <> 'train') AS new FROM ok),
sh AS (SELECT ok.*, CAST(CASE WHEN split = 'train' THEN 0 ELSE {CONFIG['num_shards']} END + idx // per AS INTEGER) AS shard_id
       FROM ok, n WHERE idx < CASE WHEN split = 'train' THEN per * {CONFIG['num_shards']} ELSE new // per * per END),
p AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY duration, idx) - 1 AS pos FROM sh),
r AS (SELECT *, row_number() OVER (PARTITION BY shard_id, k ORDER BY pos) - 1 AS rep FROM p),
b AS (SELECT r.*, 'clips_shared_' || r.k || CASE WHEN rep = 0 THEN '' ELSE '-sub' || rep END || '.wav' AS member, f.size, f.digest
      FROM r JOIN v_shared_audio f ON f.k = r.k)"""


def _built(spark, sf) -> str:
    """A new data set of the train split, then a version with shards of the other rows."""
    m, files, root = V.v_repeats(spark, sf).drop("doc_id"), V.v_shared_audio(spark, sf), scratch_path(spark, "dataset")
    BD.create(m.where("split = 'train'"), files, root, CONFIG)
    BD.append(m.where("split <> 'train'"), files, root)
    return root


@query("snk5_build_dataset", covers=("SNK4", "SNK5", "SNK6", "SRC9", "SRC10", "WIN1", "WIN2", "WIN4", "WIN5"),
       sql=f"""{BUILT}
SELECT utt_id, shard_id, member AS audio_filepath, duration, text, size, digest FROM b""")
def snk5_build_dataset(spark, sf):
    """Rows of the data set, paired with the tar members they name and the digest of those bytes."""
    root = _built(spark, sf)
    rows = BD.read(spark, root)
    held = SS.attach_content(SS.tar_index(spark, BD.folders(spark, root))).select("tar", "member", F.md5("content").alias("digest"))
    return rows.join(held, ["tar", "member"]).select("utt_id", "shard_id", "audio_filepath", "duration", "text", "size", "digest")


@query("snk6_build_versions", covers=("SNK6", "SNK4", "AGG10"),
       sql=f"""{BUILT},
s AS (SELECT shard_id, count(*) AS rows, count(DISTINCT k) AS files, CAST(sum(CASE WHEN rep = 0 THEN size END) AS BIGINT) AS bytes FROM b GROUP BY shard_id),
v AS (SELECT 0 AS version, CAST({CONFIG['num_shards']} AS INTEGER) AS num_shards, 0 AS n_history, false AS is_concatenated_manifest
      UNION ALL SELECT 1, CAST({CONFIG['num_shards']} + new // per AS INTEGER), 1, true FROM n)
SELECT version, num_shards, n_history, is_concatenated_manifest, true AS sort_in_shards, CAST(per AS INTEGER) AS num_samples_per_shard,
       shard_id, rows, files, bytes
FROM v JOIN s ON s.shard_id < v.num_shards, n""")
def snk6_build_versions(spark, sf):
    """Every version with the shards that reading it gives, as their writers counted them."""
    root = _built(spark, sf)
    parts = []
    for v in (0, 1):
        meta = KS.read_versions(spark, f"{root}/metadata").where(F.col("version") == v).select(
            "version", "dataset_config.num_shards", F.size("history").alias("n_history"), "is_concatenated_manifest",
            "dataset_config.sort_in_shards", "num_samples_per_shard")
        parts.append(BD.shard_list(spark, root, v).withColumn("version", F.lit(v)).join(meta, "version"))
    return parts[0].unionByName(parts[1]).select(
        "version", "num_shards", "n_history", "is_concatenated_manifest", "sort_in_shards", "num_samples_per_shard", "shard_id", "rows",
        "files", "bytes")


@query("src9_subset_export", covers=("SRC9", "JOIN1", "JOIN2", "PRJ10", "PRJ11", "WIN3", "SNK5"),
       sql=f"""{BUILT},
k2 AS (SELECT CAST(doc_id AS VARCHAR) AS utt_id, CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic, 1 AS version FROM labels
       UNION ALL SELECT CAST(doc_id AS VARCHAR), 'relabelled', CAST(toxic AS VARCHAR), 2 FROM labels WHERE toxic = 1),
l AS (SELECT utt_id, max_by(quality, version) AS quality, max_by(toxic, version) AS toxic FROM k2 GROUP BY utt_id)
SELECT b.utt_id, b.utt_id || '.wav' AS audio_filepath, b.duration, l.quality, l.toxic,
       CAST((row_number() OVER (ORDER BY b.utt_id) - 1) // 40 AS INTEGER) AS shard_id, b.size, b.digest
FROM b JOIN l ON l.utt_id = b.utt_id""")
def src9_subset_export(spark, sf):
    """The labelled rows of the data set as a data set of their own, with their last labels, read back."""
    root, out = _built(spark, sf), scratch_path(spark, "subset")
    BD.export_subset(spark, root, _keep2(spark, sf), out, order="version", shard_size=40)
    index = SS.tar_index(spark, out)
    held = SS.attach_content(index).select("tar", "member", F.md5("content").alias("digest"))
    rows = SS.pair(SS.read_entries(spark, out), index).join(held, ["tar", "member"])
    return rows.select("utt_id", "audio_filepath", "duration", F.col("custom")["quality"].alias("quality"),
                       F.col("custom")["toxic"].alias("toxic"), "shard_id", "size", "digest")
