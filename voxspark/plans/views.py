"""Test views over the driver tables (FIXTURES.md section 3), in Spark and as DuckDB CTE
text.  Both sides derive everything from the given tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import spread

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- v_manifest
def _split(doc_id: Column) -> Column:
    m = doc_id % 10
    return F.when(m == 0, "test").when(m == 1, "validate").otherwise("train")


def v_manifest(spark: SparkSession, sf_dir: str, keep_doc_id: bool = False) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    cols = [
        F.col("doc_id").cast("string").alias("utt_id"),
        F.col("source").alias("dataset"),
        _split(F.col("doc_id")).alias("split"),
        F.concat(F.lit("clips/"), "source", F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".wav")).alias("audio_filepath"),
        (F.col("n_chars").cast("double") / F.lit(16.0)).alias("duration"),
        "text",
        F.col("lang").alias("source_lang"),
        F.col("lang").alias("target_lang"),
        F.lit("asr").alias("taskname"),
        F.lit("yes").alias("pnc"),
    ]
    if keep_doc_id:
        cols.append("doc_id")
    return d.select(*cols)


V_MANIFEST = """v_manifest AS (
  SELECT CAST(doc_id AS VARCHAR) AS utt_id, doc_id, source AS dataset,
         CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'validate' ELSE 'train' END AS split,
         'clips/' || source || '/' || CAST(doc_id AS VARCHAR) || '.wav' AS audio_filepath,
         CAST(n_chars AS DOUBLE) / 16.0 AS duration, text,
         lang AS source_lang, lang AS target_lang, 'asr' AS taskname, 'yes' AS pnc
  FROM documents)"""


# ---------------------------------------------------------------- v_repeats
def v_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest where one audio file holds many rows (file by doc_id % 50)."""
    m = v_manifest(spark, sf_dir, keep_doc_id=True)
    return m.withColumn("audio_filepath", F.concat(
        F.lit("clips/shared/"), (F.col("doc_id") % 50).cast("string"), F.lit(".wav")))


V_REPEATS = """v_repeats AS (
  SELECT * REPLACE ('clips/shared/' || CAST(doc_id % 50 AS VARCHAR) || '.wav' AS audio_filepath)
  FROM v_manifest)"""


# ---------------------------------------------------------------- v_tokens
def v_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest + ``tokens`` = number of white-space words of the text."""
    m = v_manifest(spark, sf_dir, keep_doc_id=True)
    return m.withColumn("tokens", F.size(X.raw_words("text")).cast("int"))


def sql_ws_class() -> str:
    return (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def sql_strip(e: str) -> str:
    ws = sql_ws_class()
    return f"regexp_replace({e}, '^{ws}+|{ws}+$', '', 'g')"


def sql_squeeze(e: str) -> str:
    return sql_strip(f"regexp_replace({e}, '{sql_ws_class()}+', ' ', 'g')")


def sql_words(e: str) -> str:
    """Words of an already squeezed string."""
    return f"list_filter(string_split({e}, ' '), lambda w: w <> '')"


def sql_raw_words(e: str) -> str:
    return sql_words(sql_squeeze(f"coalesce({e}, '')"))


V_TOKENS = f"""v_tokens AS (
  SELECT *, CAST(len({sql_raw_words('text')}) AS INTEGER) AS tokens FROM v_manifest)"""


# ---------------------------------------------------------------- text oracles
def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_clean_text(e: str) -> str:
    for a, b in X.CLEAN_REPLACEMENTS:
        e = f"replace({e}, {sql_lit(a)}, {sql_lit(b)})"
    e = sql_strip(e)
    e = f"replace({e}, '…', '...')"
    # no look-behind in RE2: the consuming form twice (matches overlap by one char)
    for _ in range(2):
        e = rf"regexp_replace({e}, '(^|[^.])\.\.([^.]|$)', '\1...\2', 'g')"
    e = rf"regexp_replace({e}, '([?!])\.\.([^.]|$)', '\1...\2', 'g')"
    e = f"regexp_replace({e}, '\"{{2,}}', '\"', 'g')"
    return (f"(SELECT CASE WHEN (length(q) - length(replace(q, '\"', ''))) % 2 = 1 "
            f"THEN regexp_replace(q, '\"([^\"]*)$', '\\1') ELSE q END FROM (SELECT {e} AS q))")


def sql_no_punct(e: str) -> str:
    chars = X.ASCII_PUNCTUATION + X.EXTRA_PUNCTUATION
    inner = f"lower(translate({e}, {sql_lit(chars)}, ''))"
    return f"coalesce({sql_squeeze(inner)}, '')"


# ---------------------------------------------------------------- v_pairs
def prediction_text(ref_words: Column, doc_id: Column) -> Column:
    """Synthetic hypothesis: word i (from 1) dropped if (doc_id+i)%13=0, else 'x' if
    %11=0, else doubled if %17=0 (``array_join`` skips the nulls of dropped words)."""
    def one(w, i):
        k = doc_id + i + 1
        return (F.when(k % 13 == 0, F.lit(None).cast("string"))
                .when(k % 11 == 0, F.lit("x"))
                .when(k % 17 == 0, F.concat(w, F.lit(" "), w))
                .otherwise(w))
    return F.array_join(F.transform(ref_words, one), " ")


def v_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(utt_id, lang, split, prediction, reference): reference is the whole manifest
    text; prediction is derived from its punctuation-free words."""
    return _pairs(spark, sf_dir).drop("np")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_pairs`` with ``np``, the punctuation-free reference."""
    m = v_manifest(spark, sf_dir, keep_doc_id=True)
    base = m.select("utt_id", "doc_id", F.col("source_lang").alias("lang"), "split",
                    F.col("text").alias("reference"), X.no_punct("text").alias("np"))
    return base.select("utt_id", "doc_id", "lang", "split", "reference",
                       prediction_text(X.words("np"), F.col("doc_id")).alias("prediction"), "np")


def sql_prediction(words_e: str, doc_e: str) -> str:
    return (f"array_to_string(flatten(list_transform({words_e}, lambda w, i: CASE "
            f"WHEN ({doc_e} + i) % 13 = 0 THEN []::VARCHAR[] "
            f"WHEN ({doc_e} + i) % 11 = 0 THEN ['x'] "
            f"WHEN ({doc_e} + i) % 17 = 0 THEN [w, w] ELSE [w] END)), ' ')")


V_PAIRS = f"""v_pairs AS (
  SELECT utt_id, doc_id, source_lang AS lang, split, text AS reference,
         {sql_prediction(sql_words(sql_no_punct('text')), 'doc_id')} AS prediction
  FROM v_manifest)"""


# ---------------------------------------------------------------- v_turn_pairs
def v_turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(utt_id, role, prediction, reference) of every turn of ``conversations``, by the same rule."""
    c = table(spark, sf_dir, "conversations")
    c = c.select(F.concat_ws("-", "conv_id", "turn").alias("utt_id"), "role", F.col("text").alias("reference"), X.no_punct("text").alias("np"),
                 (F.col("conv_id") * 31 + F.col("turn")).alias("k"))
    return c.select("utt_id", "role", "reference", prediction_text(X.words("np"), F.col("k")).alias("prediction"))


def sql_turn_edits() -> str:
    """WITH clause with ``scored`` (k, role, kind, edits, words): word edits of every turn, raw
    and without punctuation, by one row of the distance table per reference word."""
    sides = " UNION ALL ".join(
        f"SELECT 2 * k + {n} AS k, role, '{kind}' AS kind, {f('prediction')} AS h, {f('reference')} AS r FROM v_turn_pairs"
        for n, (kind, f) in enumerate([("raw", sql_raw_words), ("np", lambda e: sql_words(sql_no_punct(e)))]))
    return f"""WITH RECURSIVE v_turn_pairs AS (
  SELECT row_number() OVER () AS k, role, text AS reference,
         {sql_prediction(sql_words(sql_no_punct('text')), '(conv_id * 31 + turn)')} AS prediction
  FROM conversations),
sides AS MATERIALIZED ({sides}),
dp AS (
  SELECT k, 0 AS i, range(len(h) + 1) AS d FROM sides
  UNION ALL
  SELECT k, i + 1, list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]),
           lambda a, x: list_append(a, least(a[-1] + 1, d[x[1] + 1] + 1,
                                             d[x[1]] + CASE WHEN h[x[1]] = r[i + 1] THEN 0 ELSE 1 END)),
           [CAST(i + 1 AS BIGINT)])
  FROM dp JOIN sides USING (k) WHERE i < len(r)),
scored AS (SELECT k, role, kind, d[-1] AS edits, len(r) AS words FROM dp JOIN sides USING (k) WHERE i = len(r))"""


# ---------------------------------------------------------------- v_keep (subset)
def v_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subset manifest: the labelled documents, with their labels as custom fields."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").cast("string").alias("utt_id"),
        F.create_map(F.lit("quality"), F.col("quality").cast("string"),
                     F.lit("toxic"), F.col("toxic").cast("string")).alias("custom"))


V_KEEP = """v_keep AS (
  SELECT CAST(doc_id AS VARCHAR) AS utt_id, quality, toxic FROM labels)"""


# ---------------------------------------------------------------- v_scores
def _score(key: Column) -> Column:
    k = F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") % 1025
    return k.cast("double") / F.lit(1024.0)


def sql_score(key_e: str) -> str:
    return f"(CAST(('0x' || substr(md5({key_e}), 1, 4)) AS INTEGER) % 1025) / 1024.0"


def v_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(utt_id, lang, correct, score): labels joined to documents."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return (lab.join(docs, "doc_id")
            .select(F.col("doc_id").cast("string").alias("utt_id"), "lang",
                    F.col("quality").alias("correct"),
                    _score(F.col("doc_id").cast("string")).alias("score")))


V_SCORES = f"""v_scores AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS utt_id, d.lang, l.quality AS correct,
         {sql_score('CAST(l.doc_id AS VARCHAR)')} AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""




# ---------------------------------------------------------------- v_audio
def v_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio store: (path, content) for the labelled documents only, so the other
    manifest rows have missing audio.  Content is a 16-bit WAV of ``n_chars`` samples
    at 16 Hz (so its length agrees with the manifest duration)."""
    from ..functions.naming import wav_bytes
    d = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return d.select(
        F.concat(F.lit("clips/"), "source", F.lit("/"), F.col("doc_id").cast("string"),
                 F.lit(".wav")).alias("path"),
        wav_bytes(F.col("n_chars")).alias("content"))


def v_shared_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio store of ``v_repeats``: (path, content), one WAV per shared file."""
    from ..functions.naming import wav_bytes
    d = table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 50).alias("k")).agg(F.max(F.col("n_chars") % 4096).alias("n"))
    return d.select(F.concat(F.lit("clips/shared/"), F.col("k").cast("string"), F.lit(".wav")).alias("path"),
                    wav_bytes(F.col("n")).alias("content"))


def _sql_le(e: str, width: int) -> str:
    """Little-endian hex digits of a number."""
    return " || ".join(f"printf('%02X', CAST(({e} >> {8 * i}) & 255 AS INTEGER))" for i in range(width))


#: Size and digest of the same files, byte for byte.
V_SHARED_AUDIO = f"""v_shared_audio AS (
  SELECT k, 44 + 2 * n AS size,
         md5(unhex('52494646' || {_sql_le('(2 * n + 36)', 4)} || '57415645666D7420' || '10000000' || '0100' || '0100' || '10000000'
             || '20000000' || '0200' || '1000' || '64617461' || {_sql_le('(2 * n)', 4)} || repeat('0000', n))) AS digest
  FROM (SELECT doc_id % 50 AS k, CAST(max(n_chars % 4096) AS BIGINT) AS n FROM documents GROUP BY 1))"""


# ---------------------------------------------------------------- v_token_scores
def v_token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens = words of the hypothesis by position; correct when equal to the reference
    word at the same position; score from md5(doc_id-i); a word = 3 neighbours."""
    p = _pairs(spark, sf_dir)
    p = p.select("utt_id", "doc_id", "lang", X.words("prediction").alias("pw"), X.words("np").alias("rw"))
    # zip hypothesis and reference words by position and explode once (no per-token
    # copy of the whole reference array); positions past the hypothesis are dropped
    z = F.arrays_zip(F.col("pw").alias("w"), F.col("rw").alias("r"))
    t = (p.select("utt_id", "doc_id", "lang", F.posexplode(z).alias("i", "wr"))
         .filter(F.col("wr.w").isNotNull()))
    key = F.concat(F.col("doc_id").cast("string"), F.lit("-"), F.col("i").cast("string"))
    return t.select(
        "utt_id", "lang", "i", (F.col("i") / 3).cast("int").alias("word_id"),
        F.when(F.col("wr.w") == F.col("wr.r"), 1).otherwise(0).alias("correct"),
        _score(key).alias("score"))


V_TOKEN_SCORES = f"""v_token_scores AS (
  SELECT utt_id, lang, i - 1 AS i, CAST((i - 1) // 3 AS INTEGER) AS word_id,
         CASE WHEN w = rw[i] THEN 1 ELSE 0 END AS correct,
         {sql_score("CAST(doc_id AS VARCHAR) || '-' || CAST(i - 1 AS VARCHAR)")} AS score
  FROM (SELECT utt_id, doc_id, lang, rw, unnest(pw) AS w, generate_subscripts(pw, 1) AS i
        FROM (SELECT utt_id, doc_id, lang, {sql_words('prediction')} AS pw,
                     {sql_words(sql_no_punct('reference'))} AS rw FROM v_pairs)))"""


def with_views(*names: str) -> str:
    """WITH clause holding the named views (and what they need)."""
    order = ["v_manifest", "v_repeats", "v_tokens", "v_pairs", "v_keep", "v_scores",
             "v_token_scores", "v_shared_audio"]
    need = {"v_repeats": {"v_manifest"}, "v_tokens": {"v_manifest"},
            "v_pairs": {"v_manifest"}, "v_token_scores": {"v_pairs", "v_manifest"}}
    want = set(names)
    for n in list(want):
        want |= need.get(n, set())
    text = {"v_manifest": V_MANIFEST, "v_repeats": V_REPEATS, "v_tokens": V_TOKENS,
            "v_pairs": V_PAIRS, "v_keep": V_KEEP, "v_scores": V_SCORES,
            "v_token_scores": V_TOKEN_SCORES, "v_shared_audio": V_SHARED_AUDIO}
    return "WITH " + ",\n".join(text[n] for n in order if n in want)
