"""Mixing sources: targets, schedule and taken words against plain versions."""

import math
import random
import re

import pytest

from voxspark.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """The stated rule, step by step: stop at the limit, share the excess again by weight."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > 2 * sizes[s]]
        if not over:
            return got | {s: left * w[s] / total for s in open_}
        for s in over:
            got[s] = 2.0 * sizes[s]
            open_.discard(s)
        left -= sum(got[s] for s in over)
    return got


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def made(seed, n=120, sources=("a", "b", "B", "é", None)):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.randint(1, 4) for _ in range(int(rng.paretovariate(0.7)) % 900)), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rows = made(seed) + [(900, None, "a"), (901, "", "zero"), (902, " \t\x0b", None), (None, "x y", "b"), (7, "again", "a"), (7, "again", "a")]
    got = M.taken(frame(spark, rows), block=16).collect()
    assert len(got) == len(rows)
    size, taken, target = {}, {}, {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(WORD.findall(t or ""))) for i, t, _ in rows)
    want = plain_targets(size)
    for s in size:
        assert math.isclose(target[s], want[s], rel_tol=1e-12, abs_tol=1e-9)
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, M.taken(frame(spark, rows[::-1]), block=16).collect()))


def test_slots_are_even_in_every_stretch(spark):
    own = spark.createDataFrame([(0, 5000), (1, 2111), (2, 64), (3, 0)], "number int, quota long")
    got = sorted((r.slot, r.number, r.block) for r in M.slots(own, block=8).collect())
    n = {0: 625, 1: 264, 2: 8}
    total = sum(n.values())
    bits = (total - 1).bit_length()
    edges = [0, 625, 889, 897]
    want = []
    for k in range(2 ** bits):                           # the points themselves, one by one
        j = int(format(k, f"0{bits}b")[::-1], 2)
        if j < total:
            want.append((k, max(s for s in range(3) if edges[s] <= j)))
    assert [(s, i) for s, i, _ in got] == want
    seen = {0: 0, 1: 0, 2: 0}
    for at, (_, number, rank) in enumerate(got, 1):
        assert rank == seen[number]
        seen[number] += 1
        assert all(abs(seen[s] - at * n[s] / total) <= 2 + bits for s in n)
    assert seen == n


def test_blocks_are_equal_and_whole(spark, monkeypatch):
    """Hash ranges, stretches and copies of a few rows give what one range gives."""
    docs = frame(spark, made(5, 80) + [(5000, "a b c", "a")] * 30)
    base = M.sizes(docs).cache()
    own = M.targets(base).cache()
    whole = sorted((r.number, r.block, r.id, r.copy, r.repeat, r.first, r.tokens) for r in M.mix(base, own, 16).collect())
    monkeypatch.setattr(M, "RANGE", 4)
    monkeypatch.setattr(M, "STRETCH", 8)
    split = sorted((r.number, r.block, r.id, r.copy, r.repeat, r.first, r.tokens) for r in M.mix(base, own, 16).collect())
    assert whole == split
    quota = {r.number: r.quota for r in own.collect()}
    per, spans = {}, {}
    for number, block, id, copy, repeat, first, tokens in whole:
        per[number, block] = per.get((number, block), 0) + tokens
        spans.setdefault((number, id, copy, repeat), []).append((first, tokens))
    for (number, block), tokens in per.items():
        assert tokens == min(16, quota[number] - 16 * block)
    assert sum(per.values()) == sum(quota.values())
    for parts in spans.values():                          # a document's pieces follow each other from its first token
        at = 0
        for first, tokens in sorted(parts):
            assert first == at and tokens > 0
            at += tokens


def test_copies_in_parts_and_salted_sources(spark, monkeypatch):
    docs = frame(spark, [(1, "a b", "s")] * 23 + [(2, "c d e", "t")] * 3 + [(None, None, None)])
    want = sorted(map(str, M.taken(docs, block=4).collect()))
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, M.taken(docs, block=4).collect())) == want
    monkeypatch.setattr(M, "COPIES", 5)
    got = M.taken(docs, block=4).collect()
    assert len(got) == 27 and abs(sum(r.taken for r in got) - 1.5 * 55) <= 1
    assert all(r.taken <= 2 * r.size for r in got)


def test_texts_empty_and_extra_columns(spark):
    rows = made(9, 40, ("a", "b"))
    docs = frame(spark, rows)
    base = M.sizes(docs)
    own = M.targets(base)
    words = {i: WORD.findall(t) for i, t, _ in rows}
    got = M.texts(docs, M.mix(base, own, 16)).collect()
    assert got and all(r.words == words[r.id][r.first:r.first + r.tokens] for r in got)
    assert M.taken(docs.where("false")).collect() == []
    named = docs.selectExpr("*", "1 as size", "2 as n", "3 as taken", "4 as at", "5 as id", "6 as copy", "7 as range", "8 as target")
    assert sorted(map(str, M.taken(named, block=16).collect())) == sorted(map(str, M.taken(docs, block=16).collect()))
    assert [r.target for r in M.taken(frame(spark, [(1, "", "a"), (2, None, "b")])).collect()] == [0.0, 0.0]


def test_plan_is_native(spark):
    base = M.sizes(frame(spark, made(1, 10)))
    plan = M.mix(base, M.targets(base))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
