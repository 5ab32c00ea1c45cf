"""Queries: word and character frequencies, vocabularies, training, encoding
(AGG12, AGG13, TOP1, TOK1-TOK9, SRC11, SCL21)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import naming as N
from ..functions import text as X
from ..operators import vocab as VO
from ..session import scratch_path
from . import views as V
from .registry import query

COVERAGE = 0.9995
LANGS = ["en", "de", "fr", "es"]


def _texts(spark, sf):
    """TOK1: the vocabulary corpus = all manifest texts (no dedup)."""
    return VO.vocab_corpus([V.v_manifest(spark, sf)])


WORDS_SQL = f"SELECT unnest({V.sql_raw_words('lower(text)')}) AS word FROM documents"
CHARS_SQL = (f"SELECT piece, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), '(?s).')) AS piece "
             f"FROM documents) WHERE NOT regexp_matches(piece, '^{V.sql_ws_class()}$') GROUP BY piece")


@query("agg12_word_freq", covers=("AGG12", "TOK1"),
       sql=f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) GROUP BY word")
def agg12_word_freq(spark, sf):
    return VO.word_freq(_texts(spark, sf))


@query("top1_word_vocab", covers=("TOP1", "TOK5"),
       sql=f"SELECT word, count(*) AS count FROM ({WORDS_SQL}) GROUP BY word ORDER BY count DESC, word LIMIT 100")
def top1_word_vocab(spark, sf):
    return VO.word_vocab(_texts(spark, sf), 100)


CHAR_VOCAB_SQL = f"""f AS ({CHARS_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY count DESC, piece) - 1 AS rank,
             sum(count) OVER (ORDER BY count DESC, piece ROWS UNBOUNDED PRECEDING) AS cum,
             sum(count) OVER () AS tot FROM f),
cv AS (SELECT piece, count, rank FROM r WHERE cum - count < {COVERAGE} * tot)"""


@query("agg13_char_vocab", covers=("AGG13", "TOK4"),
       sql=f"WITH {CHAR_VOCAB_SQL}\nSELECT piece, count, CAST(rank AS INTEGER) AS rank FROM cv")
def agg13_char_vocab(spark, sf):
    v = VO.char_vocab(_texts(spark, sf), COVERAGE)
    return v.select("piece", "count", F.col("rank").cast("int"))


@query("src11_read_vocab", covers=("SRC11",),
       sql=f"WITH {CHAR_VOCAB_SQL}\nSELECT 'chars' AS lang, CAST(rank + 1 AS INTEGER) AS id, piece, "
           f"CAST(-rank AS DOUBLE) AS score FROM cv UNION ALL SELECT 'chars', 0, '<unk>', 0.0")
def src11_read_vocab(spark, sf):
    cv = VO.char_vocab(_texts(spark, sf), COVERAGE)
    unk = spark.createDataFrame([(0, VO.UNK, 0.0)], "id int, piece string, score double")
    vocab = unk.unionByName(cv.select((F.col("rank") + 1).cast("int").alias("id"), "piece",
                                      (-F.col("rank")).cast("double").alias("score")))
    root = scratch_path(spark, "vocab")
    VO.write_vocab(vocab, f"{root}/chars")
    return VO.read_vocab(spark, f"{root}/chars")


@query("tok7_wordpiece_text", covers=("TOK7",),
       sql=f"""WITH w AS (SELECT word, count(*) AS count FROM ({WORDS_SQL}) GROUP BY word),
{CHAR_VOCAB_SQL},
p AS (SELECT '<unk>' AS piece UNION ALL SELECT '▁' UNION ALL SELECT '▁' || word FROM w
      UNION ALL SELECT piece FROM cv)
SELECT piece, CASE WHEN piece = '<unk>' THEN NULL WHEN piece = '▁' THEN piece
                   WHEN starts_with(piece, '▁') THEN substr(piece, 2) ELSE '##' || piece END AS wp
FROM p""")
def tok7_wordpiece_text(spark, sf):
    texts = _texts(spark, sf)
    words = VO.word_freq(texts).select(F.concat(F.lit(VO.WORD_START), "word").alias("piece"))
    cv = VO.char_vocab(texts, COVERAGE).select("piece")
    fixed = spark.createDataFrame([(VO.UNK,), (VO.WORD_START,)], "piece string")
    p = fixed.unionByName(words).unionByName(cv)
    return p.select("piece", VO.wordpiece_text(F.col("piece")).alias("wp"))


@query("tok8_aggregate_vocab", covers=("TOK8",),
       sql=f"""WITH f AS (SELECT lang, piece, count(*) AS count FROM (
                SELECT lang, unnest(regexp_extract_all(lower(text), '(?s).')) AS piece FROM documents)
              WHERE NOT regexp_matches(piece, '^{V.sql_ws_class()}$') GROUP BY lang, piece),
r AS (SELECT lang, piece, row_number() OVER (PARTITION BY lang ORDER BY count DESC, piece) - 1 AS id FROM f),
o AS (SELECT lang, CASE lang {' '.join(f"WHEN '{l}' THEN {i}" for i, l in enumerate(LANGS))} END AS o,
             count(*) AS n FROM r GROUP BY lang),
off AS (SELECT lang, coalesce(sum(n) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset FROM o)
SELECT r.lang, CAST(r.id AS INTEGER) AS id, r.piece, CAST(off.offset + r.id AS INTEGER) AS global_id
FROM r JOIN off USING (lang)""")
def tok8_aggregate_vocab(spark, sf):
    d = V.table(spark, sf, "documents")
    f = (d.select("lang", F.explode(VO.chars(F.lower("text"))).alias("piece"))
         .filter(~F.col("piece").rlike(f"^{X.WS_CLASS}$"))
         .groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("count")))
    # per-language ranks over the (bounded) character tables
    w = Window.partitionBy("lang").orderBy(F.col("count").desc(), "piece")
    per = f.withColumn("id", (F.row_number().over(w) - 1).cast("int")).select("lang", "id", "piece")
    return VO.aggregate_vocab(per, LANGS).select("lang", "id", "piece", "global_id")


BPE_SIZE = 256


def _bpe(spark, sf):
    return VO.train_subwords(_texts(spark, sf), BPE_SIZE, coverage=COVERAGE)


@query("tok2_train_bpe", covers=("TOK2", "SCL21", "H-4"))
def tok2_train_bpe(spark, sf):
    v = _bpe(spark, sf)
    name = N.vocab_name(F.lit("spe"), F.lit("bpe"), F.lit(BPE_SIZE), F.lit(-1), F.lit(False),
                        F.lit(False), F.lit(False))
    return v.withColumn("run_name", name)


@query("tok3_train_wordpiece", covers=("TOK3",))
def tok3_train_wordpiece(spark, sf):
    return VO.train_subwords(_texts(spark, sf), BPE_SIZE, wordpiece=True, coverage=COVERAGE)


MERGES = 24


def _sql_train(wordpiece: bool) -> str:
    """The plain rule, one merge a step: count neighbours over all words, join the most frequent pair
    (ties by symbols) in every word.  Each symbol stands between blanks of its own, so that
    ``replace`` goes from left to right without overlaps."""
    first = VO.WORD_START if not wordpiece else ""
    cont = VO.WPE_CONT if wordpiece else ""
    joined = "a || b" if not wordpiece else "a || substr(b, 3)"
    split = "regexp_extract_all(word, '(?s).')"
    sym = (f"list_transform({split}, lambda c, i: CASE WHEN i = 1 THEN c ELSE '{cont}' || c END)" if wordpiece
           else f"list_prepend('{first}', {split})")
    steps = [f"""w0 AS (SELECT ' ' || array_to_string({sym}, '  ') || ' ' AS seq, n
       FROM (SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word))"""]
    for k in range(MERGES):
        steps.append(f"""m{k} AS (SELECT p[1] AS a, p[2] AS b, sum(n) AS n FROM (
  SELECT unnest(list_zip(s[:-2], s[2:])) AS p, n FROM (SELECT string_split(substr(seq, 2, length(seq) - 2), '  ') AS s, n FROM w{k}))
  GROUP BY 1, 2 ORDER BY n DESC, a, b LIMIT 1),
w{k + 1} AS MATERIALIZED (SELECT replace(seq, ' ' || a || '  ' || b || ' ', ' ' || {joined} || ' ') AS seq, w{k}.n FROM w{k}, m{k})""")
    specials = VO.WPE_SPECIALS if wordpiece else [VO.UNK]
    heads = " UNION ALL ".join(f"SELECT {i} AS id, '{p}' AS piece, 0.0::DOUBLE AS score" for i, p in enumerate(specials))
    found = " UNION ALL ".join(f"SELECT {len(specials) + k}, {joined}, CAST(-{k} AS DOUBLE) FROM m{k}" for k in range(MERGES))
    at = len(specials) + MERGES
    chars_ = f"SELECT piece, row_number() OVER (ORDER BY count DESC, piece) - 1 AS r, count(*) OVER () AS k FROM ({CHARS_SQL})"
    if wordpiece:
        base = (f"SELECT {at} + r, piece, CAST(-({MERGES} + r) AS DOUBLE) FROM cr UNION ALL "
                f"SELECT {at} + k + r, '{cont}' || piece, CAST(-({MERGES} + k + r) AS DOUBLE) FROM cr")
    else:
        base = (f"SELECT {at}, '{first}', CAST(-{MERGES} AS DOUBLE) UNION ALL "
                f"SELECT {at} + 1 + r, piece, CAST(-({MERGES} + 1 + r) AS DOUBLE) FROM cr")
    name = "tokenizer_wpe_" if wordpiece else "tokenizer_spe_bpe_"
    size = f"{len(specials) + MERGES} + (SELECT {'2 * ' if wordpiece else '1 + '}max(k) FROM cr)"
    return f"""WITH {', '.join(steps)}, cr AS ({chars_}),
v AS ({heads} UNION ALL {found} UNION ALL {base})
SELECT CAST(id AS INTEGER) AS id, piece, score, '{name}v' || CAST({size} AS VARCHAR) || '_max_9_bos' AS run_name FROM v"""


def _first_merges(spark, sf, wordpiece: bool):
    """All characters and the first merges over all texts, with the run's name (SCL21)."""
    texts = _texts(spark, sf)
    letters = VO.char_vocab(texts, 1.0).count()
    size = MERGES + (len(VO.WPE_SPECIALS) + 2 * letters if wordpiece else 2 + letters)
    v = VO.train_subwords(texts, size, wordpiece=wordpiece, max_piece_len=9)
    kind, spe = ("wpe", "") if wordpiece else ("spe", "bpe")
    name = N.vocab_name(F.lit(kind), F.lit(spe), F.lit(size), F.lit(9), F.lit(False), F.lit(True), F.lit(False))
    return v.withColumn("run_name", F.regexp_replace(name, "__v", "_v"))


@query("tok2_train_bpe_merges", covers=("TOK2", "SCL21"), sql=_sql_train(False))
def tok2_train_bpe_merges(spark, sf):
    return _first_merges(spark, sf, False)


@query("tok3_train_wordpiece_merges", covers=("TOK3", "SCL21"), sql=_sql_train(True))
def tok3_train_wordpiece_merges(spark, sf):
    return _first_merges(spark, sf, True)


@query("tok6_encode", covers=("TOK6",))
def tok6_encode(spark, sf):
    return VO.encode_counts(V.v_manifest(spark, sf), _bpe(spark, sf))


def _counted(m, vocab):
    slots = N.prompt_slots(F.create_map(
        F.lit("source_lang"), F.concat(F.lit("<|"), "source_lang", F.lit("|>")),
        F.lit("target_lang"), F.concat(F.lit("<|"), "target_lang", F.lit("|>"))))
    return VO.token_count(m, VO.encode_counts(m, vocab), slots).select("utt_id", "prompt_tokens", "text_tokens", "tokens")


@query("tok9_token_count", covers=("TOK9", "SCL18"))
def tok9_token_count(spark, sf):
    return _counted(V.v_manifest(spark, sf), _bpe(spark, sf))


def _characters(spark, sf):
    """A vocabulary of word start and covered characters: a word is its characters."""
    cv = VO.char_vocab(_texts(spark, sf), COVERAGE).select("piece")
    fixed = spark.createDataFrame([(VO.UNK,), (VO.WORD_START,)], "piece string")
    return fixed.union(cv).withColumn("score", F.lit(0.0))


CHAR_TOKENS_SQL = f"""WITH {CHAR_VOCAB_SQL},
ps AS (SELECT map_from_entries(list(ROW(piece, 1))) AS m FROM cv),
w AS (SELECT CAST(doc_id AS VARCHAR) AS utt_id, {V.sql_raw_words('lower(text)')} AS ws FROM documents),
e AS (SELECT utt_id, flatten(list_transform(ws, lambda x: list_prepend('▁', list_transform(
        regexp_extract_all(x, '(?s).'), lambda c: CASE WHEN map_contains(m, c) THEN c ELSE '<unk>' END)))) AS pieces FROM w, ps)"""


@query("tok6_encode_chars", covers=("TOK6",),
       sql=f"""{CHAR_TOKENS_SQL}
SELECT utt_id, array_to_string(pieces, ' ') AS pieces, CAST(len(pieces) AS BIGINT) AS text_tokens FROM e""")
def tok6_encode_chars(spark, sf):
    e = VO.encode(V.v_manifest(spark, sf), _characters(spark, sf))
    return e.select("utt_id", F.array_join("pieces", " ").alias("pieces"), "text_tokens")


@query("tok9_token_count_chars", covers=("TOK9", "SCL18"),
       sql=f"""{CHAR_TOKENS_SQL}
SELECT utt_id, prompt_tokens, CAST(len(pieces) AS BIGINT) AS text_tokens, prompt_tokens + 2 + CAST(len(pieces) AS BIGINT) AS tokens
FROM e JOIN (SELECT CAST(doc_id AS VARCHAR) AS utt_id,   -- five filled defaults and the two languages
                    CAST(CASE WHEN lang IS NULL THEN 5 ELSE 7 END AS INTEGER) AS prompt_tokens FROM documents) USING (utt_id)""")
def tok9_token_count_chars(spark, sf):
    return _counted(V.v_manifest(spark, sf), _characters(spark, sf))
