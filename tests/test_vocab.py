"""Vocabularies: training against one merge at a time, encoding, invariants (TOK2-TOK9)."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from voxspark.operators import vocab as VO
from voxspark.plans import views as V


def _bpe(counts: dict[str, int], merges: int) -> list[str]:
    """One merge at a time: the most frequent pair, ties by symbols."""
    words = {w: [VO.WORD_START, *w] for w in counts}
    out = []
    while len(out) < merges:
        pairs = Counter()
        for w, s in words.items():
            for p in zip(s, s[1:]):
                pairs[p] += counts[w]
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p))
        if a + b not in out:
            out.append(a + b)
        for w, s in words.items():
            i, new = 0, []
            while i < len(s):
                two = s[i:i + 2] == [a, b]
                new.append(a + b if two else s[i])
                i += 2 if two else 1
            words[w] = new
    return out


def test_bpe_invariants(spark):
    texts = VO.vocab_corpus([V.v_manifest(spark, SF)])
    v = VO.train_subwords(texts, 120, coverage=1.0, merges_per_round=8)
    rows = v.orderBy("id").collect()
    pieces = [r.piece for r in rows]
    assert len(pieces) == 120 and len(set(pieces)) == 120 and pieces[0] == "<unk>"
    assert [r.id for r in rows] == list(range(120))
    # every base character of the corpus is in the vocabulary
    alphabet = {r.piece for r in VO.char_vocab(texts, 1.0).collect()}
    assert alphabet <= set(pieces)
    enc = VO.encode_counts(V.v_manifest(spark, SF), v).agg(F.sum("text_tokens")).first()[0]
    words = VO.word_freq(texts).agg(F.sum("count")).first()[0]
    assert enc >= words                      # at least one piece per word


def test_bpe_is_one_merge_at_a_time(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aabcde") for _ in range(rnd.randint(1, 7))) for _ in range(150)]
    text = " ".join(rnd.choice(words) for _ in range(900))
    counts = Counter(text.split())
    base = 2 + len(set(text) - {" "})
    v = VO.train_subwords(spark.createDataFrame([(text,)], "text string"), base + 30)
    assert [r.piece for r in v.orderBy("id").collect()][1:31] == _bpe(counts, 30)


def test_wordpiece_ranks_by_count(spark):
    df = spark.createDataFrame([("abab ab ab ab zq",)], "text string")
    v = VO.train_subwords(df, len(VO.WPE_SPECIALS) + 8 + 2, wordpiece=True)
    assert [r.piece for r in v.orderBy("id").collect()][5:7] == ["ab", "##ab"]


def test_specials_and_sizes(spark):
    df = spark.createDataFrame([("ab <x> ab",)], "text string")
    sp = VO.special_pieces(pad="<pad>", bos="<s>", eos="</s>", control=("<c>",), user=("<x>",))
    assert sp == ["<pad>", "<unk>", "<s>", "</s>", "<c>", "<x>"]
    v = VO.train_subwords(df, 14, specials=sp, user=("<x>",))
    pieces = [r.piece for r in v.orderBy("id").collect()]
    assert pieces[:6] == sp and "ab" in pieces or "▁a" in pieces
    assert not any("<x" in p or "x>" in p for p in pieces[6:])
    with pytest.raises(ValueError):
        VO.train_subwords(df, 5, specials=sp)


def test_encode_rows(spark):
    vocab = spark.createDataFrame([("<unk>", 0.0), ("▁a", -1.0), ("ab", -0.5), ("▁", -9.0), ("a", -9.0), ("b", -9.0)],
                                  "piece string, score double")
    df = spark.createDataFrame([("1", "ab a?b"), ("2", ""), ("3", None)], "utt_id string, text string")
    got = {r.utt_id: (r.pieces, r.text_tokens) for r in VO.encode(df, vocab).collect()}
    assert got == {"1": (["▁", "ab", "▁a", "<unk>", "b"], 5), "2": ([], 0), "3": ([], 0)}


def test_wordpiece_text_rule(spark):
    df = spark.createDataFrame([("<unk>",), ("▁",), ("▁ab",), ("cd",)], "p string")
    got = [r.w for r in df.select(VO.wordpiece_text(F.col("p")).alias("w")).collect()]
    assert got == [None, "▁", "ab", "##cd"]


def test_aggregate_vocab_offsets(spark):
    v = spark.createDataFrame([("ru", 0, "a"), ("ru", 1, "b"), ("en", 0, "c")], "lang string, id int, piece string")
    got = sorted((r.lang, r.id, r.global_id) for r in VO.aggregate_vocab(v, ["en", "ru"]).collect())
    assert got == [("en", 0, 0), ("ru", 0, 1), ("ru", 1, 2)]


def test_encoding_hands_rows_on_in_small_batches():
    """A batch of many long texts comes out by slices: a task holds one slice's pieces at a time."""
    import pyarrow as pa
    text = "ab a\u00a0?b " * 5_000
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(40)]), pa.array([text, None] * 20, pa.string())], ["key", "text"])
    pieces = {"\u2581a": -1.0, "ab": -0.5, "\u2581": -9.0, "a": -9.0, "b": -9.0}
    got = list(VO._coder(pieces, False)(iter([batch])))
    assert len(got) >= 5 and max(b.num_rows for b in got) <= 8
    assert [k for b in got for k in b.column(0).to_pylist()] == [str(i) for i in range(40)]
    first = got[0].column(1)[0].as_py()
    assert first[:7] == ["\u2581", "ab", "\u2581a", "\u2581", "<unk>", "b", "\u2581"] and got[0].column(1)[1].as_py() == []
    counts = list(VO._coder(pieces, True)(iter([batch])))
    assert [n for b in counts for n in b.column(1).to_pylist()] == [len(first), 0] * 20


def test_rounds_rewrite_blocks_of_numbers():
    """A round over blocks equals merging word by word: runs of equal symbols, breaks, words used up."""
    import numpy as np
    import pyarrow as pa
    names = [VO.WORD_START, "a", "b", "c"]
    words = {"aaaaa": 3, "abab": 5, "ab\u00e9aaab": 7, "c": 2, "\u00e9": 1, "bcca": 11}
    batch = pa.RecordBatch.from_arrays([pa.array(list(words)), pa.array(list(words.values()), pa.int64())], ["word", "count"])
    merges = [("a", "a", "aa"), ("b", "c", "bc")]
    listed = names + [m for _, _, m in merges]
    block, = VO._first_blocks(listed, False)(iter([batch]))
    after, = VO._next_blocks(listed, [tuple(map(listed.index, m)) for m in merges])(iter([block.slice(0, 1)]))
    first, then = Counter(), Counter()
    for w, n in words.items():
        s = [VO.WORD_START, *w]
        for out in (first, then):
            for p in zip(s, s[1:]):
                if "\u00e9" not in p:
                    out[p] += n
            for a, b, ab in merges:
                i, new = 0, []
                while i < len(s):
                    two = s[i:i + 2] == [a, b]
                    new.append(ab if two else s[i])
                    i += 2 if two else 1
                s = new
    for got, want in ((block, first), (after, then)):
        assert {(r["a"], r["b"]): r["n"] for r in got.to_pylist() if r["symbols"] is None} == dict(want)
    assert (np.frombuffer(after.column(0)[0].as_py(), np.int32) < 0).sum() * 8 == len(after.column(1)[0].as_py())


def test_character_counts_come_from_words(spark):
    texts = spark.createDataFrame([("Ab\u00a0aB  b\n",), (None,), ("",), ("\u1680 c",)], "text string")
    assert {r["piece"]: r["count"] for r in VO.char_freq(texts).collect()} == {"a": 2, "b": 3, "c": 1}
    plan = VO.char_freq(texts)._jdf.queryExecution().toString()
    assert "word" in plan                   # one row a distinct word, not one a character of the texts
