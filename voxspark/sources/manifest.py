"""Manifest readers (SRC1-SRC8, SRC10).

A manifest is JSON lines, one utterance per line, open schema.  We read lines as text
and parse them with ``from_json`` twice: into the fixed schema for known keys and into
``map<string,string>`` for the rest (``custom``), so unknown keys survive and a bad
line is a flagged row instead of a failed job.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..session import hadoop_path

# Known manifest keys and their types.
KNOWN_KEYS = [
    ("utt_id", "string"), ("dataset", "string"), ("split", "string"),
    ("audio_filepath", "string"), ("audio_file", "string"), ("duration", "double"),
    ("offset", "double"), ("text", "string"), ("source_lang", "string"),
    ("target_lang", "string"), ("lang", "string"), ("taskname", "string"),
    ("pnc", "string"), ("shard_id", "int"),
]
KNOWN_DDL = ", ".join(f"`{k}` {t}" for k, t in KNOWN_KEYS)
MANIFEST_COLUMNS = ["utt_id", "dataset", "split", "audio_filepath", "duration", "text",
                    "source_lang", "target_lang", "taskname", "pnc", "shard_id", "custom"]


def as_paths(paths) -> list[str]:
    """SRC3/SRC4: a glob, a comma-separated list or a list of paths."""
    if isinstance(paths, str):
        return [p.strip() for p in paths.split(",") if p.strip()]
    return [p for ps in paths for p in as_paths(ps)]


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON lines: known keys as columns, the rest in ``custom``, ``is_error``
    for lines that are not a JSON object.  Blank lines are dropped uncounted."""
    v = F.col(value)
    lines = lines.filter(X.py_strip(v) != "")
    as_map = F.from_json(v, "map<string,string>")
    parsed = F.from_json(v, KNOWN_DDL)
    known = F.array(*[F.lit(k) for k, _ in KNOWN_KEYS])
    out = lines.select("*", parsed.alias("_p"), as_map.alias("_m"))
    # keys that came from hive-style folders (``split=train/``) fill in parsed nulls
    dirs = {k for k, _ in KNOWN_KEYS if k in lines.columns}

    def key(k, t):
        c = F.col(f"_p.{k}")
        return (F.coalesce(c, F.col(f"`{k}`").cast(t)) if k in dirs else c).alias(k)
    return out.select(
        *[c for c in lines.columns if c != value and c not in dirs], v.alias("line"),
        *[key(k, t) for k, t in KNOWN_KEYS],
        F.map_filter("_m", lambda k, _: ~F.array_contains(known, k)).alias("custom"),
        F.col("_m").isNull().alias("is_error"),
        F.map_contains_key(F.coalesce("_m", F.create_map().cast("map<string,string>")),
                           F.lit("text")).alias("has_text_key"))


def read_manifest_lines(spark: SparkSession, paths, folders: bool = False) -> DataFrame:
    """All non-blank lines with their file and parse result (for corpus statistics).  ``folders``: a
    manifest that Spark wrote is its folder, so ``file`` names the folder in place of each part file."""
    file = F.col("_metadata.file_path")
    if folders:
        file = F.regexp_replace(file, "/part-[^/]*$", "")
    # one read per path so each keeps its own partition discovery (split=... folders)
    parts = [spark.read.text(p).select("*", file.alias("file")) for p in as_paths(paths)]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return parse_lines(raw)


def read_texts(spark: SparkSession, paths) -> DataFrame:
    """SRC4: plain text files as a corpus, a text a line; one read of all paths."""
    return spark.read.text(as_paths(paths)).select(F.col("value").alias("text"))


def audio_key(df: DataFrame) -> DataFrame:
    """PRJ6: ``audio_filepath`` else ``audio_file``; neither is an error (D-5: the
    key is renamed on read)."""
    c = F.coalesce(F.col("audio_filepath"), F.col("audio_file"))
    c = F.when(c.isNull(), F.raise_error(F.concat(
        F.lit("manifest entry has neither audio_filepath nor audio_file: "),
        F.coalesce(F.col("line"), F.lit(""))))).otherwise(c)
    return df.withColumn("audio_filepath", c).drop("audio_file")


def read_manifest(spark: SparkSession, paths, strict: bool = False,
                  text_field: str | None = None, lang_field: str | None = None,
                  require_audio: bool = False) -> DataFrame:
    """SRC1: manifest rows.  ``strict``: a bad line fails the job (the sharder);
    otherwise bad lines are skipped (count them with ``read_manifest_lines``).
    PRJ12: ``text_field``/``lang_field`` name the keys holding text and language."""
    lines = read_manifest_lines(spark, paths)
    if strict:
        lines = lines.withColumn("is_error", F.when(F.col("is_error"), F.raise_error(
            F.concat(F.lit("bad manifest line: "), F.col("line")))).otherwise(F.lit(False)))
    df = lines.filter(~F.col("is_error"))
    for field, target in ((text_field, "text"), (lang_field, "lang")):
        if field and field != target:
            df = df.withColumn(target, F.col("custom")[field])
    if require_audio:
        df = audio_key(df)
    else:
        df = df.withColumn("audio_filepath", F.coalesce("audio_filepath", "audio_file"))
    return df.drop("is_error", "has_text_key", "audio_file")


def scan_manifests(spark: SparkSession, root: str, exclude=()) -> DataFrame:
    """SRC2 + FLT6: every manifest under ``root/<dataset>/``; dataset = first folder
    under root (``dataset=`` prefix allowed), split = the ``split=`` folder or the file
    name part before the first ``_``.  Excluded datasets are pruned by path."""
    raw = (spark.read.option("recursiveFileLookup", "true").text(root)
           .select("value", F.col("_metadata.file_path").alias("file")))
    # the file's path without scheme and authority, percent signs undone; under the root, whole and quoted
    path = F.url_decode(F.replace(F.regexp_replace("file", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    fs, p = hadoop_path(spark, root)
    under = p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getPath().rstrip("/") + "/"
    rel = F.when(path.startswith(under), F.substring(path, len(under) + 1, 1 << 30)).otherwise(path)
    seg = F.split(rel, "/")
    ds = F.regexp_replace(F.element_at(seg, 1), "^dataset=", "")
    fname = F.element_at(seg, -1)
    split_dir = F.regexp_extract(rel, r"(?:^|/)split=([^/]+)/", 1)
    split = F.when(split_dir != "", split_dir).otherwise(F.regexp_extract(fname, r"^([^_]+)_", 1))
    raw = raw.withColumn("_ds", ds).withColumn("_split", split)
    raw = raw.filter(fname.endswith("_manifest.jsonl") | (split_dir != ""))
    if exclude:
        raw = raw.filter(~F.col("_ds").isin(list(exclude)))
    df = parse_lines(raw).filter(~F.col("is_error"))
    return (df.withColumn("dataset", F.coalesce("dataset", "_ds"))
              .withColumn("split", F.coalesce("split", "_split"))
              .drop("_ds", "_split", "is_error", "has_text_key"))


def mix(dfs: list[DataFrame], weights: list[float], key: str = "utt_id") -> DataFrame:
    """SRC6: finite weighted mix without replacement: keep a row of source i when
    ``hash(key) < w_i / max(w)`` (hash = first 8 hex digits of md5 as a fraction).
    Deterministic and re-computable, unlike ``sample`` under retries."""
    top = max(weights)
    parts = []
    for i, (df, w) in enumerate(zip(dfs, weights)):
        h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double")
        parts.append(df.filter(h / F.lit(4294967296.0) < F.lit(w / top))
                     .withColumn("source_index", F.lit(i)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@dataclass(frozen=True)
class Input:
    """One source of rows: ``kind`` is ``manifest`` (JSON lines) or ``shards`` (a shard directory)."""
    kind: str
    path: str
    weight: float = 1.0


#: Settings that name a source, and its kind.
INPUT_KEYS = {"manifest_filepath": "manifest", "cuts_path": "manifest", "shar_path": "shards"}


def _small_text(spark: SparkSession, path: str) -> str:
    """A configuration file, by whatever file system Spark reads."""
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _from_config(spark: SparkSession, items, weight: float, above: tuple[str, ...]) -> list[Input]:
    """Entries of a configuration; a group's weight multiplies those inside it.  An ``input_cfg`` may be
    a list or the path of another file."""
    if isinstance(items, str):
        if items in above:
            raise ValueError(f"input configuration names itself: {' > '.join([*above, items])}")
        import yaml
        cfg = yaml.safe_load(_small_text(spark, items))
        return _from_config(spark, cfg.get("input_cfg", cfg) if isinstance(cfg, dict) else cfg, weight, (*above, items))
    out: list[Input] = []
    for it in items:
        w = weight * float(it.get("weight", 1.0))
        if "input_cfg" in it:
            out += _from_config(spark, it["input_cfg"], w, above)
            continue
        named = [k for k in INPUT_KEYS if k in it]
        if not named:
            raise ValueError(f"input entry names no source ({', '.join(INPUT_KEYS)}): {it}")
        out += [Input(INPUT_KEYS[named[0]], p, w) for p in as_paths(it[named[0]])]
    return out


def resolve_inputs(spark: SparkSession, spec) -> list[Input]:
    """SRC5: what an input specification names.  A path or a comma list of paths, a list of paths,
    ``[[path, weight], ...]`` (also as text), a YAML file (nested ``input_cfg`` groups), a shard directory (a folder that
    holds ``cuts.<n>.jsonl``), or ``key=value`` with a key of ``INPUT_KEYS`` or ``input_cfg``."""
    if not isinstance(spec, str):
        spec = list(spec)
        if spec and isinstance(spec[0], (list, tuple)):
            return [Input(i.kind, i.path, i.weight * float(w[0] if w else 1.0)) for p, *w in spec for i in resolve_inputs(spark, str(p))]
        return [i for p in spec for i in resolve_inputs(spark, str(p))]
    s = spec.strip()
    if s.startswith("["):
        import yaml
        return resolve_inputs(spark, yaml.safe_load(s))
    key, _, value = s.partition("=")
    if value and "/" not in key:
        if key == "input_cfg":
            return _from_config(spark, value, 1.0, ())
        if key not in INPUT_KEYS:
            raise ValueError(f"unknown input setting {key}: one of {', '.join([*INPUT_KEYS, 'input_cfg'])}")
        return [Input(INPUT_KEYS[key], p) for p in as_paths(value)]
    if s.endswith((".yaml", ".yml")):
        return _from_config(spark, s, 1.0, ())
    return [Input("shards" if _is_shard_folder(spark, p) else "manifest", p) for p in as_paths(s)]


def _is_shard_folder(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path.rstrip("/") + "/cuts.*.jsonl*")
    return bool(fs.globStatus(p))


def read_shard_folder(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a shard directory: ``cuts.<n>.jsonl`` (or ``.gz``) zipped by line with the files of further fields,
    ``<field>.<n>.jsonl``, whose values join ``custom`` under the field's name.  A line that a field's file
    does not have leaves the row without it; positions are counted per file, a shard at the most."""
    raw = (spark.read.option("pathGlobFilter", "*.jsonl*").text(path)
           .select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"))
           .withColumn("at", F.monotonically_increasing_id()))
    name = F.split("file", r"\.")
    raw = raw.withColumn("field", name[0]).withColumn("shard", name[1])
    line = F.row_number().over(Window.partitionBy("file").orderBy("block", "at")) - 1
    raw = raw.withColumn("line_no", line)
    cuts = parse_lines(raw.where("field = 'cuts'").drop("file", "block", "at", "field")).where("not is_error").drop("is_error", "has_text_key", "line")
    extra = (raw.where("field <> 'cuts'").groupBy("shard", "line_no")
             .agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_fields")))      # an entry a field
    out = cuts.join(extra, ["shard", "line_no"], "left").withColumn(
        "custom", F.when(F.col("_fields").isNull(), F.col("custom")).otherwise(
            F.map_concat(F.map_filter("custom", lambda k, _: ~F.map_contains_key(F.col("_fields"), k)), F.col("_fields"))))
    return out.withColumn("shard_id", F.coalesce("shard_id", F.col("shard").cast("int"))).drop("shard", "_fields", "line_no")


def read_inputs(spark: SparkSession, spec) -> DataFrame:
    """SRC5 + SRC6: the rows that a specification names, sources mixed by their weights."""
    found = resolve_inputs(spark, spec)
    dfs = [read_shard_folder(spark, i.path) if i.kind == "shards" else read_manifest(spark, i.path) for i in found]
    return mix(dfs, [i.weight for i in found])


# ------------------------------------------------------------------ nested sources
def audio_segments(path: Column) -> Column:
    """PRJ4: path segments, dropping everything up to and including
    ``extracted/<hash>/``."""
    seg = F.filter(F.split(path, "/"), lambda s: s != "")
    pos = F.array_position(seg, F.lit("extracted"))
    return F.when(pos > 0, F.slice(seg, (pos + 2).cast("int"), F.lit(1 << 30))).otherwise(seg)


def replace_ext(path: Column, ext: str = ".wav") -> Column:
    """PRJ5: replace the extension of the last segment (``os.path.splitext``)."""
    from ..operators.manifest import path_ext
    old = path_ext(path)
    return F.concat(F.substring(path, F.lit(1), F.length(path) - F.length(old)), F.lit(ext))


def wav_path(path: Column, base: Column) -> Column:
    """PRJ4+PRJ5: ``base/<segments after extracted/hash>.wav``."""
    return F.concat_ws("/", base, replace_ext(F.array_join(audio_segments(path), "/")))


def to_manifest(src: DataFrame, dataset: str, audio_col: str = "mp3", json_col: str = "json",
                source_lang: str = "ru", target_lang: str = "ru", taskname: str = "asr",
                pnc: str = "yes", split_col: str = "split") -> DataFrame:
    """SRC7/SRC8 + PRJ1-PRJ5 + SCL8: nested source rows (all splits at once) -> manifest
    rows.  ``audio`` is ``struct<path, array, sampling_rate>``; duration = samples / rate."""
    a = F.col(audio_col)
    base = F.concat(F.lit("./datasets/"), F.lit(dataset), F.lit("/"), F.col(split_col),
                    F.lit("/audio"))
    out = src.select(
        "*",
        wav_path(a["path"], base).alias("audio_filepath"),
        (F.size(a["array"]).cast("double") / a["sampling_rate"].cast("double")).alias("duration"),
        X.clean_text(F.col(json_col)["text"]).alias("text"),
        F.lit(source_lang).alias("source_lang"), F.lit(target_lang).alias("target_lang"),
        F.lit(taskname).alias("taskname"), F.lit(pnc).alias("pnc"))
    return out.drop(audio_col, json_col, "__key__", "__url__")
