"""Spelling variants against a plain walk over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from voxspark.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(S.UPPER, S.LOWER)


def plain_words(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def distance_one(a, b):
    """Edit distance of exactly one, by trying every deletion and replacement."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_forms(n):
    near = {w: [o for o in n if o != w and distance_one(w, o)] for w in n}
    form = {}
    for w, os in near.items():
        if os:
            best = min(os, key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows_of(got):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}


def made(seed, size=600):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé×") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    text = []
    for _ in range(size):
        w = rng.choice(base[:1 + int(40 * rng.random() ** 2)])
        for _ in range(rng.choice((0, 0, 1, 2))):
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(("", "a", "b", "zz")) + w[k + 1:]
        text.append(rng.choice((w, w, w.upper(), w.capitalize())))
    return [(i, rng.choice((" ", "-", "1 ", "ā")).join(text[i::20])) for i in range(20)]


@pytest.mark.parametrize("seed,pieces,block", [(1, 4, 512), (2, 2, 4), (3, 3, 7), (4, 1, 16), (5, 9, 2)])
def test_equal_to_all_pairs(spark, seed, pieces, block):
    rows = made(seed) * 3
    n = plain_words(rows)
    want = plain_forms(n)
    assert sum(v[0] is not None for v in want.values()) > 5
    assert rows_of(S.variants(docs(spark, rows), pieces=pieces, block=block)) == want


def test_small_tiles_share_and_split(spark, monkeypatch):
    rows = made(6, 1500) * 3
    want = plain_forms(plain_words(rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")      # tiles run over batches
    try:
        assert rows_of(S.variants(docs(spark, rows), block=40)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edges(spark):
    assert S.variants(docs(spark, [])).collect() == []
    assert S.variants(docs(spark, [(1, None), (None, ""), (2, "1 2 āāāāā")])).collect() == []
    long = "q" * 5000
    rows = [(None, "ABCDE abcde AbcdÉ abcdÉ abcdÉ " * 4), (1, f"{long} " * 8), (1, f"{long}q " * 3), (2, "abcdef " * 3), (2, "abcdef " * 3)]
    assert rows_of(S.variants(docs(spark, rows))) == plain_forms(plain_words(rows))
    clash = docs(spark, rows).selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as i", "5 as form", "6 as part")
    assert rows_of(S.variants(clash)) == plain_forms(plain_words(rows))


def test_chain_to_its_root(spark):
    """Each word has twice the count of the one before: forms lead on to the last."""
    words = ["abcdefgh"[:5] + "x" * k for k in range(12)]
    rows = [(0, " ".join(f"{w} " * (3 * 2 ** k) for k, w in enumerate(words)))]
    got = rows_of(S.variants(docs(spark, rows)))
    assert got == plain_forms(plain_words(rows))
    assert got[words[0]][1] == words[-1]


def test_one_edit_only_once(spark):
    vocab = spark.createDataFrame([("aaaaa", 3), ("aaaaaa", 4), ("aaaaaaa", 5), ("baaaa", 6), ("aaaab", 7)], "word string, n long")
    got = sorted(tuple(sorted((r.a, r.b))) for r in S.near_pairs(vocab).collect())
    ws = [r.word for r in vocab.collect()]
    assert got == sorted(tuple(sorted((a, b))) for i, a in enumerate(ws) for b in ws[i + 1:] if distance_one(a, b))
