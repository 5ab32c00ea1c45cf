"""Row-level manifest operators: defaults, paths, filters, set operations and counts
(PRJ1-PRJ14, FLT1-FLT6, SET1-SET4, AGG4-AGG7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# Defaults of a manifest row, columns of raw sources, custom keys of the loader.
DEFAULTS = {"source_lang": "ru", "target_lang": "ru", "taskname": "asr", "pnc": "yes"}
RAW_COLUMNS = ["__key__", "__url__", "mp3", "wav", "json"]
DROP_CUSTOM_KEYS = ["dataloading_info", "shard_id"]


def with_defaults(df: DataFrame, **overrides) -> DataFrame:
    """PRJ1: fill language/task/pnc columns (existing non-null values win)."""
    vals = {**DEFAULTS, **overrides}
    for k, v in vals.items():
        df = df.withColumn(k, F.coalesce(F.col(k), F.lit(v)) if k in df.columns else F.lit(v))
    return df


def drop_raw(df: DataFrame) -> DataFrame:
    """PRJ2: drop source-only columns."""
    return df.drop(*[c for c in RAW_COLUMNS if c in df.columns])


def duration(n_samples: Column, rate: Column) -> Column:
    """PRJ3: seconds from a sample count and a rate."""
    return n_samples.cast("double") / rate.cast("double")


def _le_uint(content: Column, at: Column, width: int) -> Column:
    """Little-endian number of ``width`` bytes at byte ``at``; null behind the end."""
    h = F.hex(F.substring(content, at + 1, F.lit(width)))
    parts = [F.substring(h, 2 * i + 1, 2) for i in reversed(range(width))]
    return F.when(F.length(h) == 2 * width, F.conv(F.concat(*parts), 16, 10).cast("long"))


#: Chunks that are looked through; those in front of the samples are few.
WAV_CHUNKS = 256


def wav_duration(content: Column) -> Column:
    """PRJ3 from bytes: data bytes / byte rate of a RIFF file, its chunks followed one by one (name, size,
    content, a padding byte after odd sizes) to the first ``fmt `` and ``data``.  Null where either is not
    there or the bytes are no WAV.  Of a file that ends early, the bytes that are there count."""
    start = F.struct(F.lit(12).cast("long").alias("at"), F.lit(None).cast("long").alias("rate"), F.lit(None).cast("long").alias("data"))

    def chunk(state, _):
        at, open_ = state["at"], state["rate"].isNull() | state["data"].isNull()
        name, size = F.hex(F.substring(content, at.cast("int") + 1, F.lit(4))), _le_uint(content, at.cast("int") + 4, 4)
        here = open_ & size.isNotNull()
        rate = F.when(here & state["rate"].isNull() & (name == "666D7420"), _le_uint(content, at.cast("int") + 16, 4)).otherwise(state["rate"])
        held = F.least(size, F.length(content) - at - 8)
        data = F.when(here & state["data"].isNull() & (name == "64617461"), held).otherwise(state["data"])
        return F.struct(F.when(here, F.least(at + 8 + size + size % 2, F.length(content).cast("long"))).otherwise(at).alias("at"),
                        rate.alias("rate"), data.alias("data"))

    riff = (F.hex(F.substring(content, 1, 4)) == "52494646") & (F.hex(F.substring(content, 9, 4)) == "57415645")
    # a chunk takes eight bytes at least
    chunks = F.least(F.greatest(F.floor((F.length(content) - 12) / 8), F.lit(0)), F.lit(WAV_CHUNKS))
    seconds = F.aggregate(F.sequence(F.lit(0).cast("long"), chunks), start, chunk,
                          lambda s: F.try_divide(s["data"].cast("double"), s["rate"].cast("double")))
    return F.when(riff, seconds)


def resolve_path(path: Column, manifest_file: Column) -> Column:
    """PRJ7: relative audio paths are taken relative to the manifest's folder."""
    folder = F.regexp_extract(manifest_file, r"^(.*)/[^/]*$", 1)
    return F.when(path.startswith("/"), path).otherwise(F.concat_ws("/", folder, path))


def path_ext(path: Column) -> Column:
    """Extension as ``os.path.splitext`` sees it: from the last '.' of the last segment,
    unless only dots precede it in that segment ('' then)."""
    base = F.regexp_extract(path, r"[^/]*$", 0)
    return F.regexp_extract(base, r"^\.*[^.].*(\.[^.]*)$", 1)


def squash(path: Column) -> Column:
    """PRJ8: flatten a path into a member name: in the part before the extension '/'
    and '.' become '_'; the extension is kept."""
    ext = path_ext(path)
    base = F.substring(path, F.lit(1), F.length(path) - F.length(ext))
    return F.concat(F.translate(base, "/.", "__"), ext)


def export_rows(df: DataFrame, id_col: str = "utt_id") -> DataFrame:
    """PRJ10 + PRJ11: subset export row as JSON: ``<id>.flac``, duration, text and lang
    only when non-empty, then the cleaned custom keys (they override)."""
    base = F.create_map(
        F.lit("audio_filepath"), F.concat(F.col(id_col), F.lit(".flac")),
        F.lit("duration"), F.col("duration").cast("string"),
        F.lit("text"), F.nullif(F.col("text"), F.lit("")),
        F.lit("lang"), F.nullif(F.col("lang"), F.lit("")))
    custom = clean_custom(F.coalesce(F.col("custom"), F.create_map().cast("map<string,string>")))
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(custom, k)), custom)
    merged = F.map_filter(merged, lambda k, v: v.isNotNull())
    return df.withColumn("export", F.to_json(merged))


def clean_custom(m: Column) -> Column:
    """PRJ11: drop null values and loader bookkeeping keys from a custom map."""
    drop = F.array(*[F.lit(k) for k in DROP_CUSTOM_KEYS])
    return F.map_filter(m, lambda k, v: v.isNotNull() & ~F.array_contains(drop, k))


def tps(tokens: Column, dur: Column) -> Column:
    """PRJ14: tokens per second (infinite for a zero-length row)."""
    return F.when(dur > 0, tokens.cast("double") / dur).otherwise(F.lit(float("inf")))


# ------------------------------------------------------------------ filters
def duration_predicate(lo: float | None = None, hi: float | None = None,
                       closed: bool = False, col: str = "duration") -> Column:
    """FLT1 (half-open ``lo <= d < hi``) / FLT2 (closed); missing bounds are open."""
    d = F.col(col)
    p = F.lit(True)
    if lo is not None:
        p = p & (d >= lo)
    if hi is not None:
        p = p & ((d <= hi) if closed else (d < hi))
    return p


def split_by(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """SET4: (rows where pred holds, the complement); null counts as not holding."""
    p = F.coalesce(pred, F.lit(False))
    return df.filter(p), df.filter(~p)


def filter_duration(df: DataFrame, lo=None, hi=None, closed=False):
    """FLT1/FLT2: kept and filtered result sets."""
    return split_by(df, duration_predicate(lo, hi, closed))


def rejections(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """FLT3: one pass: total rows, rows failing any predicate, failures per predicate."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in preds.values()])
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(~ok).alias("rejected")]
    aggs += [F.count_if(~F.coalesce(p, F.lit(False))).alias(f"rejected_{n}")
             for n, p in preds.items()]
    return df.agg(*aggs)


def has_text(c: str = "text") -> Column:
    """FLT4: key present and value non-empty (before any strip)."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def exclude(df: DataFrame, names, col: str = "dataset") -> DataFrame:
    """FLT6: drop named data sets."""
    return df.filter(~F.col(col).isin(list(names)))


# ------------------------------------------------------------------ set operations
def combine(dfs: list[DataFrame]) -> DataFrame:
    """SET1: union all by name, duplicates kept, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def concat(base: DataFrame, *new: DataFrame) -> DataFrame:
    """SET2: base first, then the appended manifests: ``source_order`` gives the order."""
    parts = [d.withColumn("source_order", F.lit(i)) for i, d in enumerate((base,) + new)]
    return combine(parts)


def corpus(dfs: list[DataFrame], col: str = "text") -> DataFrame:
    """SET3/AGG5: distinct stripped texts of all manifests (case-sensitive); rows
    whose text is empty before the strip are skipped, and empty results are dropped
    (D-10)."""
    texts = combine([d.select(col) for d in dfs]).filter(has_text(col))
    t = texts.select(X.py_strip(col).alias("text"))
    return t.filter(F.col("text") != "").distinct()


# ------------------------------------------------------------------ counts
def manifest_counts(df: DataFrame) -> DataFrame:
    """AGG4: rows per (split, dataset), per split (dataset null) and overall."""
    return df.rollup("split", "dataset").agg(F.count(F.lit(1)).alias("rows"))


def text_digest(c: Column) -> Column:
    """256 bits that stand for a text where only its identity counts: whole texts are not shuffled."""
    return F.unhex(F.sha2(c, 256))


def distinct_texts(df: DataFrame, by: list[str], col: str = "text") -> DataFrame:
    """AGG5: distinct stripped texts and rows per group, by digest."""
    return df.groupBy(*by).agg(F.count_distinct(text_digest(X.py_strip(col))).alias("distinct_texts"), F.count(F.lit(1)).alias("rows"))


def corpus_stats(lines: DataFrame) -> DataFrame:
    """AGG6: files, processed (non-empty text), unique stripped texts, duplicates,
    errors (bad JSON, missing, empty or non-string text, D-11) and the dedup rate in
    percent.  The JSON type of ``text`` comes from a variant parse of the line.  Lines are reduced
    to (file, digest) once; both distinct counts are taken from that."""
    text_type = F.schema_of_variant(F.variant_get(F.try_parse_json("line"), "$.text", "variant"))
    ok = ~F.col("is_error") & has_text("text") & (F.coalesce(text_type, F.lit("")) == "STRING")
    cells = lines.groupBy("file", F.when(ok, text_digest(X.py_strip("text"))).alias("t")).agg(F.count("*").alias("n"))
    texts = cells.groupBy("t").agg(F.sum("n").alias("n"))
    files = cells.groupBy("file").agg(F.lit(1).alias("x")).agg(F.count("*").alias("files"))
    texts = texts.agg(F.coalesce(F.sum(F.when(F.col("t").isNotNull(), F.col("n"))), F.lit(0)).alias("processed"),
                                    F.count("t").alias("unique"),
                                    F.coalesce(F.sum(F.when(F.col("t").isNull(), F.col("n"))), F.lit(0)).alias("errors"))
    s = files.unionByName(texts, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("files", "processed", "unique", "errors")])
    s = s.withColumn("duplicates", F.col("processed") - F.col("unique"))
    return s.withColumn("dedup_rate", F.when(F.col("processed") > 0,
                        F.col("duplicates") * 100.0 / F.col("processed")))


def duration_summary(df: DataFrame, lo=None, hi=None, by: list[str] | None = None) -> DataFrame:
    """AGG7: kept / filtered rows and seconds for a half-open duration filter."""
    p = F.coalesce(duration_predicate(lo, hi), F.lit(False))
    return df.groupBy(*(by or [])).agg(
        F.count_if(p).alias("kept_rows"),
        F.sum(F.when(p, F.col("duration"))).alias("kept_seconds"),
        F.count_if(~p).alias("filtered_rows"),
        F.sum(F.when(~p, F.col("duration"))).alias("filtered_seconds"))
