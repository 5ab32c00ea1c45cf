"""Sub-word vocabularies (AGG12, AGG13, TOP1, TOK1-TOK9, SRC11, SCL21).

Training runs on the distributed word-frequency table (one row per distinct word), so
the corpus is read once; each merge round rewrites blocks of words as arrays of numbers,
whose pairs are summed in the block and then by ``groupBy``.  A round takes several merges (H-4) as far as one count proves them
to be those of one merge at a time, which the tests compare.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as X
from ..session import scratch_dir

# Fixed values.
WORD_START = "▁"            # U+2581, marks a word start in sentencepiece pieces
UNK = "<unk>"
WPE_SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
WPE_CONT = "##"


def vocab_corpus(dfs: list[DataFrame], col: str = "text") -> DataFrame:
    """TOK1: all manifest texts, one per row (no dedup, unlike SET3)."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(F.col(col).alias("text")) for d in dfs])


def word_freq(texts: DataFrame, lower: bool = True, col: str = "text") -> DataFrame:
    """AGG12: white-space word counts (lower-cased unless told not)."""
    t = F.lower(F.col(col)) if lower else F.col(col)
    return (texts.select(F.explode(X.raw_words(t)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def word_vocab(texts: DataFrame, k: int, lower: bool = True) -> DataFrame:
    """TOP1/TOK5: the ``k`` most frequent words (ties by word); a top-k, no full sort."""
    return word_freq(texts, lower).orderBy(F.col("count").desc(), "word").limit(k)


def chars(c: Column) -> Column:
    """Code points of a string (``.`` with DOTALL matches one code point in Java)."""
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def _char_counts(words: DataFrame) -> DataFrame:
    """Characters of a word table: the counts of a pass over the texts, from their distinct words."""
    return (words.select(F.explode(chars(F.col("word"))).alias("piece"), "count")
            .groupBy("piece").agg(F.sum("count").alias("count")))


def char_freq(texts: DataFrame, lower: bool = True, col: str = "text") -> DataFrame:
    return _char_counts(word_freq(texts, lower, col))


def char_vocab(texts: DataFrame, coverage: float = 1.0, lower: bool = True) -> DataFrame:
    """AGG13/TOK4: smallest set of most frequent characters whose cumulative share
    reaches ``coverage``.  The window runs over the character table (bounded by the
    alphabet), not over rows."""
    f = char_freq(texts, lower)
    w = Window.orderBy(F.col("count").desc(), "piece")
    f = (f.withColumn("rank", F.row_number().over(w) - 1)
          .withColumn("_cum", F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_tot", F.sum("count").over(Window.partitionBy())))
    return (f.filter((F.col("_cum") - F.col("count")) < F.lit(coverage) * F.col("_tot"))
             .drop("_cum", "_tot"))


# ------------------------------------------------------------------ merges
# A block holds many words: the numbers of their symbols, a break (-1) behind each word and in the
# place of each symbol that never merges, and a count for each stretch between breaks.
_META = set("\\^$.|?*+()[]{}")


def _re(sym: str) -> str:
    return "".join("\\" + ch if ch in _META else ch for ch in sym)


BLOCK = 1 << 18             # symbols of a block of words, about
BLOCK_SCHEMA = "symbols binary, counts binary, a string, b string, n long"


def _tidy(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of one symbol (and none) go: they have no pairs.  ``symbols``: stretches, each with a
    break (-1) behind it; ``counts``: one count a stretch."""
    live = symbols >= 0
    before, after = np.append(False, live[:-1]), np.append(live[1:], False)
    ends = ~live & before & np.append([False, False], live[:-2])[:len(live)]
    return symbols[(live & (before | after)) | ends], counts[ends[~live]]


def _merged(symbols: np.ndarray, counts: np.ndarray, merges: list[tuple[int, int, int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """One left-to-right pass applying a set of merges ``(a, b, ab)`` without chains (no symbol is the
    second of one pair and the first of another).  A symbol made in this pass is not merged again
    in it (the same result as applying the merges one after another)."""
    firsts, seconds = np.zeros(size, bool), np.zeros(size, bool)
    firsts[[a for a, _, _ in merges]] = True
    seconds[[b for _, b, _ in merges]] = True
    at = np.flatnonzero(firsts[symbols[:-1]] & seconds[symbols[1:]] & (symbols[:-1] >= 0) & (symbols[1:] >= 0))
    order = sorted((a * size + b, ab) for a, b, ab in merges)
    keys, made = np.array([k for k, _ in order]), np.array([ab for _, ab in order], np.int32)
    pair = symbols[at].astype(np.int64) * size + symbols[at + 1]
    found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
    hit = keys[found] == pair
    at, found = at[hit], found[hit]
    # only a pair of equal symbols can follow itself at once: every other one of such a run counts
    start = np.append(True, np.diff(at) != 1)[:len(at)]
    odd = (np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))) % 2 == 1
    at, found = at[~odd], found[~odd]
    symbols = symbols.copy()
    symbols[at] = made[found]
    return _tidy(np.delete(symbols, at + 1), counts)


def _emit(symbols: np.ndarray, counts: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """A block's row and a row of each of its pairs, summed."""
    breaks = symbols < 0
    n = counts[(np.cumsum(breaks) - breaks)]
    both = ~breaks[:-1] & ~breaks[1:]
    pair = symbols[:-1][both].astype(np.int64) * len(names) + symbols[1:][both]
    sums = pa.table({"p": pair, "n": n[:-1][both]}).group_by("p").aggregate([("n", "sum")])
    pair, listed = sums["p"].to_numpy(), pa.array(names, pa.string())
    a, b = (pa.concat_arrays([pa.nulls(1, pa.string()), listed.take(pa.array(x))]) for x in np.divmod(pair, len(names)))
    none = pa.nulls(len(pair), pa.binary())
    cols = [pa.concat_arrays([pa.array([x.tobytes()], pa.binary()), none]) for x in (symbols, counts)]
    total = pa.concat_arrays([pa.nulls(1, pa.int64()), sums["n_sum"].combine_chunks().cast(pa.int64())])
    return pa.RecordBatch.from_arrays([*cols, a, b, total], ["symbols", "counts", "a", "b", "n"])


def _first_blocks(names: list[str], wordpiece: bool):
    """Batches ``(word, count)`` -> blocks and their pairs.  Characters without a number of their own
    never merge: they are breaks."""
    number = {p: i for i, p in enumerate(names)}
    points = sorted({ord(p[-1]) for p in names})
    first = np.array([number.get(chr(c), -1) for c in points], np.int32)
    later = np.array([number.get((WPE_CONT if wordpiece else "") + chr(c), -1) for c in points], np.int32)
    start = "" if wordpiece else WORD_START

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not len(b):
                continue
            text = "".join(f"{start}{w}\n" for w in b.column(0).to_pylist())
            code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            at = np.minimum(np.searchsorted(points, code), len(points) - 1)
            ends = code == 10
            heads = np.append(True, ends[:-1])
            symbols = np.where(np.array(points)[at] == code, np.where(heads, first[at], later[at]), -1).astype(np.int32)
            word = np.cumsum(ends) - ends
            held.append(_tidy(symbols, b.column(1).to_numpy()[word[symbols < 0]]))
            size += len(held[-1][0])
            if size >= BLOCK:
                yield _emit(*map(np.concatenate, zip(*held)), names)
                held, size = [], 0
        if size:
            yield _emit(*map(np.concatenate, zip(*held)), names)

    return run


def _next_blocks(names: list[str], merges: list[tuple[int, int, int]]):
    """Blocks -> the blocks after ``merges`` and their pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for symbols, counts in zip(b.column(0), b.column(1)):
                block = _merged(np.frombuffer(symbols.as_buffer(), np.int32), np.frombuffer(counts.as_buffer(), np.int64), merges, len(names))
                if len(block[0]):
                    yield _emit(*block, names)

    return run


def _alphabet(words: DataFrame, coverage: float) -> list[str]:
    """Character coverage set from the word table (same counts as a pass over the
    texts, without reading them again); bounded by the alphabet."""
    ch = _char_counts(words)
    w = Window.orderBy(F.col("count").desc(), "piece")
    ch = (ch.withColumn("_cum", F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_tot", F.sum("count").over(Window.partitionBy())))
    kept = ch.filter((F.col("_cum") - F.col("count")) < F.lit(coverage) * F.col("_tot"))
    return [r["piece"] for r in kept.orderBy(F.col("count").desc(), "piece").collect()]


def special_pieces(pad: str | None = None, unk: str = UNK, bos: str | None = None, eos: str | None = None,
                   control: tuple[str, ...] = (), user: tuple[str, ...] = ()) -> list[str]:
    """The pieces before the trained ones: padding, unknown, start and end where given, then
    control symbols (never in texts), then user-defined ones (kept whole in texts)."""
    return list(dict.fromkeys([p for p in (pad, unk, bos, eos) if p] + list(control) + list(user)))


def _provable_merges(cand: list, full: bool, limit: int, known: set[str], piece) -> list[tuple[str, str]]:
    """The next merges of one-at-a-time training, in its order, as far as one ranking of the
    pairs (``cand``, best first; ``full``: no pair is missing) proves them.

    Merging (a, b) lowers only pairs that start with b or end with a, and makes pairs of at
    most ``min(n(a, b), max n(b, *))`` and ``min(n(a, b), max n(*, a))``.  The next ranked pair
    follows if it is none of the lowered ones and strictly above everything made so far; the
    first that does not qualify ends the list.  A piece that exists already adds to the counts
    of existing pairs, so such a merge goes alone."""
    floor = 0 if full else cand[-1]["n"]
    after, before = {}, {}
    for r in cand:
        after.setdefault(r["a"], r["n"])
        before.setdefault(r["b"], r["n"])
    chosen, firsts, seconds, made = [], set(), set(), 0
    for r in cand:
        a, b, n = r["a"], r["b"], r["n"]
        seen = piece(a, b) in known
        if chosen and (a in seconds or b in firsts or n <= made or seen):
            break
        chosen.append((a, b))
        known.add(piece(a, b))
        if seen or len(chosen) >= limit:
            break
        firsts.add(a)
        seconds.add(b)
        made = max(made, min(n, max(after.get(b, floor), before.get(a, floor))))
    return chosen


def train_subwords(texts: DataFrame, vocab_size: int, wordpiece: bool = False,
                   lower: bool = True, coverage: float = 1.0, max_piece_len: int | None = None,
                   split_digits: bool = False, merges_per_round: int = 64,
                   min_pair_count: int = 1, specials: list[str] | None = None,
                   user: tuple[str, ...] = (), checkpoint_every: int = 8) -> DataFrame:
    """TOK2 (BPE, ``wordpiece=False``) / TOK3 (WordPiece): returns ``id, piece, score``.

    Both take the most frequent pair (ties by symbols) and count anew; a round takes several
    merges only where the result is provably that of one at a time, so ``merges_per_round``
    never changes the vocabulary.  Characters outside the coverage set, digits with
    ``split_digits``, ``user`` symbols and pieces longer than ``max_piece_len`` (None: no
    limit) never merge.  Specials come first (score 0), then merges in order (score -rank),
    then the characters.  A size below specials and characters is an error."""
    spark = texts.sparkSession
    scratch_dir(spark)                        # checkpoint dir set (shared on a cluster)
    words = word_freq(texts, lower).persist()
    alphabet = _alphabet(words, coverage)
    specials = specials if specials is not None else (WPE_SPECIALS if wordpiece else [UNK])
    specials = list(dict.fromkeys([*specials, *user]))
    base = [WORD_START] + alphabet if not wordpiece else \
        alphabet + [WPE_CONT + c for c in alphabet]
    target = vocab_size - len(set(specials) | set(base))
    if target < 0:
        raise ValueError(f"vocab_size {vocab_size} is below the {vocab_size - target} special pieces and characters")
    merges: list[str] = []
    known = set(specials) | set(base)
    # numbers of the symbols that can merge; "mergeable" also passes word starts and twice "#"
    names = list(dict.fromkeys([WORD_START, *(c + x for x in [*alphabet, "#", WORD_START] for c in (["", WPE_CONT] if wordpiece else [""]))]))
    number = {p: i for i, p in enumerate(names)}
    split = F.col("word")
    if user:                                  # words hold no white space: a blank is a break
        split = F.regexp_replace(split, "|".join(_re(u.lower() if lower else u) for u in sorted(user, key=len, reverse=True)), " ")
    table = words.select(split, "count").mapInArrow(_first_blocks(names, wordpiece), BLOCK_SCHEMA).persist()
    fixed = [f for u in user for x in (u, u.lower()) for f in (x, WPE_CONT + x)]

    allowed = "".join("\\" + c if c in _META | {"-", "&", "~"} else c for c in alphabet)

    def mergeable() -> Column:
        """Pairs whose merged piece may exist: covered characters only, bounded length,
        no digits when digits are split, no user-defined symbol."""
        body = F.regexp_replace(F.concat("a", "b"), f"{WPE_CONT}|{WORD_START}", "")
        ok = body.rlike(f"(?s)^[{allowed}]*$") if allowed else F.lit(False)
        if max_piece_len is not None:
            ok = ok & (F.length(body) <= max_piece_len)
        if split_digits:
            ok = ok & ~body.rlike("[0-9]")
        return ok & ~F.col("a").isin(fixed) & ~F.col("b").isin(fixed) if fixed else ok

    def piece(a: str, b: str) -> str:
        return a + b.replace(WPE_CONT, "", 1) if wordpiece else a + b

    rounds, prev, ranked = 0, None, merges_per_round * 8
    while len(merges) < target:
        pc = (table.where("symbols is null").groupBy("a", "b").agg(F.sum("n").alias("n"))
              .filter((F.col("n") >= min_pair_count) & mergeable()))
        # this job also fills the cache of the current table, so the previous one can go
        cand = pc.orderBy(F.col("n").desc(), "a", "b").limit(ranked).collect()
        if prev is not None:
            prev.unpersist()
            prev = None
        if not cand:
            break
        old = set(known)
        chosen = _provable_merges(cand, len(cand) < ranked, min(merges_per_round, target - len(merges)), known, piece)
        merges += [p for p in (piece(a, b) for a, b in chosen) if p not in old]
        rounds += 1
        joined = []
        for a, b in chosen:
            if piece(a, b) not in number:
                number[piece(a, b)] = len(names)
                names.append(piece(a, b))
            joined.append((number[a], number[b], number[piece(a, b)]))
        nxt = (table.where("symbols is not null").select("symbols", "counts")
               .mapInArrow(_next_blocks(list(names), joined), BLOCK_SCHEMA))
        if rounds % checkpoint_every == 0:
            nxt = nxt.checkpoint(eager=True)          # reliable: written to the shared dir
            table.unpersist()
        else:
            nxt = nxt.persist()                       # filled by the next pair count
            prev = table
        table = nxt
    for df in (words, table, prev):
        if df is not None:
            df.unpersist()
    rows = [(p, 0.0) for p in specials] + [(p, float(-i)) for i, p in enumerate(merges)]
    seen = {p for p, _ in rows}
    k = len(merges)
    for p in base:
        if p not in seen:
            rows.append((p, float(-k)))
            seen.add(p)
            k += 1
    return spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(rows)],
                                 "id int, piece string, score double")


# ------------------------------------------------------------------ reading / text forms
def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: ``piece<TAB>score`` files; id = line order within the file, language =
    the parent folder.  A vocabulary file is small (one line per piece), so each file
    is read whole (``wholetext``) and split with positions kept."""
    raw = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"))
    lines = raw.select(F.regexp_extract("file", r"/([^/]+)/[^/]+$", 1).alias("lang"),
                       F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n"))
                       .alias("id", "line"))
    parts = F.split("line", "\t")
    return lines.select("lang", F.col("id").cast("int"), parts[0].alias("piece"),
                        parts[1].cast("double").alias("score"))


def write_vocab(vocab: DataFrame, path: str) -> str:
    """Write ``piece<TAB>score`` in id order as one file (a vocabulary is bounded by
    its size parameter, so one writer task is fine)."""
    (vocab.orderBy("id").select(F.concat_ws("\t", "piece", F.col("score").cast("string")))
     .coalesce(1).write.mode("overwrite").text(path))
    return path


def wordpiece_text(piece: Column) -> Column:
    """TOK7: piece -> WordPiece text: ``<unk>`` dropped (null); ``▁x`` -> ``x``; a lone
    ``▁`` kept; any other piece -> ``##x``."""
    return (F.when(piece == UNK, F.lit(None).cast("string"))
            .when(piece == WORD_START, piece)
            .when(piece.startswith(WORD_START), F.substring(piece, 2, 1 << 20))
            .otherwise(F.concat(F.lit(WPE_CONT), piece)))


def aggregate_vocab(vocabs: DataFrame, langs: list[str]) -> DataFrame:
    """TOK8: one id space over per-language vocabularies: languages in the given order,
    global id = sum of the sizes of the languages before + local id.  The offsets come
    from a table with one row per language."""
    order = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])
    v = vocabs.filter(F.col("lang").isin(langs)).withColumn("_o", order[F.col("lang")])
    sizes = v.groupBy("lang", "_o").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).select("lang", "offset")
    return (v.join(F.broadcast(offs), "lang")
             .withColumn("global_id", (F.col("offset") + F.col("id")).cast("int"))
             .drop("_o", "offset"))


# ------------------------------------------------------------------ encoding
MEMO = 200_000              # words a task remembers before it starts anew
SLICE = 1 << 17             # characters of text that a task encodes before it hands on the rows


def _word_pieces(word: str, pieces: dict[str, float]) -> list[str]:
    """Greedy highest-score merges (leftmost on ties) with a heap over linked symbols;
    unknown characters -> <unk>, which never merge."""
    syms: list = [c if c in pieces else UNK for c in WORD_START + word]
    after, before = list(range(1, len(syms) + 1)), list(range(-1, len(syms) - 1))
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(syms) and UNK not in (syms[i], syms[j]) and (s := pieces.get(syms[i] + syms[j])) is not None:
            heapq.heappush(heap, (-s, i, syms[i], syms[j]))

    for i in range(len(syms) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if syms[i] != a or j >= len(syms) or syms[j] != b:
            continue                            # one of the two has been merged since
        syms[i], syms[j], after[i] = a + b, None, after[j]
        if after[i] < len(syms):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in syms if s is not None]


def _coder(pieces: dict[str, float], counts: bool):
    """Batches ``(key, text)`` -> small batches of the key and the pieces, or their number: a task
    encodes a word once and remembers it, and hands rows on by about ``SLICE`` characters,
    however large the batches are that come in."""
    names = list(dict.fromkeys([*pieces, UNK]))
    number = {p: i for i, p in enumerate(names)}

    def coded(word: str):
        got = _word_pieces(word, pieces)
        return len(got) if counts else array("i", [number[p] for p in got])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        listed = pa.array(names, pa.string())

        def one(text: str | None) -> list:
            words = (text or "").split()
            got = list(map(memo.get, words))
            if None in got:
                for i, g in enumerate(got):
                    if g is None:
                        w = words[i]
                        if w not in memo:
                            if len(memo) >= MEMO:
                                memo.clear()
                            memo[w] = coded(w)
                        got[i] = memo[w]
            return got

        def out(keys: pa.Array, rows: list) -> pa.RecordBatch:
            if counts:
                return pa.RecordBatch.from_arrays([keys, pa.array(map(sum, rows), pa.int64())], ["key", "text_tokens"])
            flat, ends = array("i"), [0]
            for row in rows:
                for ids in row:
                    flat.extend(ids)
                ends.append(len(flat))
            col = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed.take(pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat)])))
            return pa.RecordBatch.from_arrays([keys, col], ["key", "pieces"])

        for b in batches:
            at, size, rows = 0, 0, []
            for k, text in enumerate(b.column(1), 1):
                text = text.as_py()
                rows.append(one(text))
                size += len(text or "")
                if size >= SLICE or k == len(b):
                    yield out(b.column(0).slice(at, k - at), rows)
                    at, size, rows = k, 0, []

    return run


def _encoded(texts: DataFrame, vocab: DataFrame, key: str, col: str, lower: bool, counts: bool) -> DataFrame:
    """One Arrow pass without a shuffle; the vocabulary travels in the closure (bounded by its size)."""
    pieces = {r["piece"]: r["score"] for r in vocab.select("piece", "score").collect()}
    src = texts.select(F.col(key).alias("key"), (F.lower(F.col(col)) if lower else F.col(col)).alias("text"))
    value = T.StructField("text_tokens", T.LongType()) if counts else T.StructField("pieces", T.ArrayType(T.StringType()))
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), value])
    return src.mapInArrow(_coder(pieces, counts), schema).withColumnRenamed("key", key)


def encode(texts: DataFrame, vocab: DataFrame, key: str = "utt_id",
           col: str = "text", lower: bool = True) -> DataFrame:
    """TOK6: ``key, pieces, text_tokens`` of every row.  Null and empty texts have no pieces."""
    out = _encoded(texts, vocab, key, col, lower, False)
    return out.withColumn("text_tokens", F.size("pieces").cast("long"))


def encode_counts(texts: DataFrame, vocab: DataFrame, key: str = "utt_id",
                  col: str = "text", lower: bool = True) -> DataFrame:
    """TOK6: text tokens per row; the pieces are made as by ``encode`` and only their number kept."""
    return _encoded(texts, vocab, key, col, lower, True)


def token_count(df: DataFrame, encoded: DataFrame, slots: Column, key: str = "utt_id") -> DataFrame:
    """TOK9: tokens with prompt = one special token per non-empty prompt slot, plus
    start and end markers, plus the text tokens."""
    nslots = F.size(F.map_filter(slots, lambda k, v: v.isNotNull() & (v != "")))
    return (df.select(key, nslots.alias("prompt_tokens"))
              .join(encoded, key, "left")
              .withColumn("text_tokens", F.coalesce("text_tokens", F.lit(0)))
              .withColumn("tokens", F.col("prompt_tokens") + 2 + F.col("text_tokens")))
