r"""N-gram Jaccard self-join by a partitioned universe (pigeonhole), verified exactly.

A document's set holds the distinct n-word shingles of its lower-cased text (64-bit hashes).
Sets whose Jaccard similarity is t or more differ in at most H elements, H fixed by the size
of the smaller.  Per size band the universe is hashed into segments; a band's allocation gives
every segment one of two prices: ``exact`` (one unit: only equal segment subsets match) or
``one-deletion`` (two units: subsets match that differ by one element, through the subset and
all its one-deletion neighbours).  With units >= H + 1 some segment of a similar pair must
match.  The allocation of a band is the cheapest by a cost of index entries and expected
chance matches; the few units beyond H + 1 are slack.

Frequent entries.  An entry shared by more than ``crowd`` sets (a passage, a family of copies)
is not expanded.  A set that has no more units of empty segments and frequent entries than
the slack covers is still found through another entry.  The other sets are indexed anew by
their rarest elements: similar sets of n elements share t * n or more, so under any one order of all
elements, here by rising count among these sets, they meet in their first n - ceil(t * n) + 1.
A shared passage is at the end of that order; only sets that are common text almost whole meet
by the hundred.  Those are compared within the group of their element's first set, in blocks of
bounded size.  Members of a group's largest component are held in one block each and only the
others visit every block, so a settled family costs its own rows.  Blocks compare parity
sketches: about a bit an element, each flipped once per element that falls on it, so two
sketches (the wider folded) differ in no more bits than the sets do in elements, and more
bits than H rule a pair out for certain.  Sets whose
partition leaves too many segments empty are partitioned anew under another seed.

Equal sets are one class from the start.  Each class is first verified against the one
leader it shares most entries with; pairs already in one component need no check after
that.  So copies cost linear work, and no link between different texts is lost.

Defined results: words are ``[^\x20\x09-\x0D]+`` with A-Z lower-cased; fewer words than n make one
shingle; null, empty and blank texts have the empty set and link with nothing; a null id is
an id of its own; repeated rows are equal texts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written

CROWD, BLOCK, LEVELS, RATIO = 32, 512, 3, 1.7
SKETCH = 256                    # fewest bits of a sketch
BROADCAST_ROWS = 300_000
HEAVY = 20_000                  # fewer keys than this can hold more than one row in HEAVY each
SEEN = 200_000                  # classes a task remembers, so that copies among them go out once
U = np.uint64
_M1, _M2, _G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x + _G
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text (null: empty)."""
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends = np.asarray(words.offsets, dtype=np.int64)
    coded = words.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends = ends - ends[0]
    names = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    real = np.fromiter((w != "" for w in names), bool, len(names))
    code = coded.indices.to_numpy()
    keep = real[code] if len(code) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    w = table[code[keep]] if len(code) else np.zeros(0, np.uint64)
    h = mix(w)
    for k in range(1, n):
        h = mix(h[:max(0, len(w) - k)] * _M1 + w[k:])
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= n:
            out.append(np.unique(h[a:b - n + 1]))
        elif b > a:
            x = mix(w[a:a + 1] ^ U(int(b - a)))
            for k in range(a + 1, b):
                x = mix(x * _M1 + w[k:k + 1])
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    """Signed 64-bit name of a set; 0 for the empty set."""
    if not len(s):
        return 0
    x = mix(mix(s ^ U(len(s))).sum(keepdims=True) ^ mix(s * _M2).sum(keepdims=True) * _M1)
    return int(x.view(np.int64)[0]) or 1


@cache
def band_of(size: int) -> int:
    return next(k for k in range(64) if bounds(k + 1) > size)


@cache
def bounds(k: int) -> int:
    """The smallest size of band k."""
    return 1 if k == 0 else int(bounds(k - 1) * RATIO) + 1


@cache
def allocation(band: int, num: int, den: int) -> tuple[int, int, int]:
    """(exact segments, one-deletion segments, slack) of the smallest cost; (0, 0, 0) where only
    equal sets are similar.  Cost: index entries, and entries times the chance that unrelated
    sets share one (a share of the elements is common text)."""
    top = bounds(band + 1) - 1
    h = top * (den - num) // num
    if not h:
        return 0, 0, 0
    size = (bounds(band) + top) / 2
    spare = -(-(h + 1) // 4)
    best = None
    # one-deletion neighbours pay where segments would be tiny, so in small sets only
    for single in range((h + 1 + spare + 1) // 2 + 1 if h < 64 else 1):
        exact = max(0, h + 1 + spare - 2 * single)
        if single == 1 and h == 1:
            exact = 0                   # one segment is never empty: no slack is needed
        k = size / (exact + single)
        cost = exact * (1 + 200 * 0.3 ** k) + single * (1 + k) * (1 + 200 * 0.3 ** (k - 1))
        if best is None or cost < best[0]:
            best = cost, exact, single, exact + 2 * single - h - 1
    return best[1:]


def entries(s: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index entries of a set: (keys, tags).  A set is indexed under its own band, and under the
    band below where it can be the larger partner.  A tag holds band, level, whether too many
    segments were empty at that level, and the segment."""
    size, own = len(s), band_of(max(1, len(s)))
    roles = [own] + ([own - 1] if own and size * num <= (bounds(own) - 1) * den else [])
    part = mix(s * _M2)
    for band in roles:
        exact, single, slack = allocation(band, num, den)
        m = exact + single
        if not m or not size:
            continue
        for level in range(LEVELS + 1):
            salt = U((band * 8 + level) * 0x100000001B3 + 977)
            if level == LEVELS:         # so sparse under every seed: one entry for them all
                yield mix(np.array([salt], np.uint64)), np.array([band << 25 | level << 23 | 1 << 22], np.int32)
                break
            seg = ((mix(s ^ mix(salt[None] if salt.ndim else np.array([salt]))) >> U(20)) % U(m)).astype(np.int64)
            order = np.argsort(seg, kind="stable")
            segs, p = seg[order], part[order]
            first = np.concatenate([[0], np.flatnonzero(segs[1:] != segs[:-1]) + 1])
            sums, which = np.add.reduceat(p, first), segs[first]
            count = np.diff(np.concatenate([first, [size]]))
            weak = (exact - np.count_nonzero(which < exact)) + 2 * (single - np.count_nonzero((which >= exact) & (count > 1)))
            over = weak > slack // 2
            base = band << 25 | level << 23 | int(over) << 22
            place = mix(which.astype(np.uint64) * _G + salt)
            keys, tag = mix(sums + place), which
            if single:
                run = np.repeat(np.arange(len(first)), count)
                near = (which[run] >= exact) & (count[run] > 1)
                keys = np.concatenate([keys, mix((sums + place)[run][near] - p[near])])
                tag = np.concatenate([tag, which[run][near]])
            yield keys, (base + np.minimum(tag, (1 << 22) - 1)).astype(np.int32)
            if not over:
                break


def sketch(s: np.ndarray) -> bytes:
    """Parity of the elements that fall on each of the sketch's bits, about one bit an element
    (a power of two): a narrower one would be half ones for any pair of large sets."""
    width = max(SKETCH, 1 << (len(s) - 1).bit_length())
    at = ((mix(s) >> U(17)) % U(width)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=width) & 1).astype(np.uint8)).tobytes()


def _folded(a: np.ndarray, width: int) -> np.ndarray:
    """Sketches brought to ``width`` words: a bit is the parity of the wider sketch's bits on it."""
    while a.shape[-1] > width:
        half = a.shape[-1] // 2
        a = a[..., :half] ^ a[..., half:]
    return a


def _matrix(sketches: list[bytes], at: np.ndarray) -> np.ndarray:
    """The sketches at these places, all of one width, one a row."""
    return np.frombuffer(b"".join(sketches[i] for i in at), U).reshape(len(at), -1)


def _parts(b: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, rows) for i in range(0, b.num_rows, rows))


def _classes(n: int):
    def run(batches):
        for b in (p for x in batches for p in _parts(x)):
            sets = shingle_sets(b.column(3), n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64())],
                ["id", "key", "th", "n", "cls"])
    return run


def _entries(n: int, num: int, den: int):
    def run(batches):
        seen: set = set()               # of this task, bounded: copies are indexed once
        for b in (p for x in batches for p in _parts(x)):
            keys, tags, names, sizes = [], [], [], []
            for s in shingle_sets(b.column(0), n):
                c = class_of(s)
                if not len(s) or c in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(c)
                for k, t in entries(s, num, den):
                    keys.append(k)
                    tags.append(t)
                    names.append(c)
                    sizes.append(len(k))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)),
                                                  pa.array(np.repeat(np.array(names, np.int64), sizes)),
                                                  pa.array(np.concatenate(tags))], ["key", "cls", "tag"])
    return run


def _shared(crowd: int):
    """Rows sorted by key and class -> the rows of keys that several classes share, with the
    key's leader (its first class) and whether the key is crowded.  Holds ``crowd`` rows."""
    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        hot = None                      # (key, leader, last class) of a crowded key not ended
        out: list = []

        def put(k, c, t, leader, crowded):
            if len(k):
                out.append(pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(t), pa.array(leader), pa.array(crowded)],
                                                      ["key", "cls", "tag", "leader", "hot"]))

        for b in batches:
            k, c, t = (np.concatenate([h, b.column(i).to_numpy()]) for i, h in enumerate(held))
            if hot and len(k):
                n = int(np.searchsorted(k, hot[0], "right")) if k[0] == hot[0] else 0
                mine = np.flatnonzero(np.diff(np.concatenate([[hot[2]], c[:n]])) != 0)
                put(k[mine], c[mine], t[mine], np.full(len(mine), hot[1]), np.ones(len(mine), bool))
                hot = (hot[0], hot[1], c[n - 1]) if n == len(k) else None
                k, c, t = k[n:], c[n:], t[n:]
            if not len(k):
                held = [k, c, t]
                continue
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
            k, c, t = k[new], c[new], t[new]
            first = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
            last = first[-1]
            if len(k) - last > crowd:   # a long run goes out and on
                hot, done = (k[-1], c[last], c[-1]), len(k)
            else:
                done = last
            held = [k[done:], c[done:], t[done:]]
            k, c, t, first = k[:done], c[:done], t[:done], first[first < done]
            count = np.diff(np.concatenate([first, [done]]))
            run_of = np.repeat(np.arange(len(first)), count)
            pick = count[run_of] > 1
            put(k[pick], c[pick], t[pick], c[first][run_of][pick], (count > crowd)[run_of][pick])
            yield from out
            out.clear()
        k, c, t = held
        if len(k) > 1:
            put(k, c, t, np.full(len(k), c[0]), np.zeros(len(k), bool))
        yield from out
    return run


def _sets(n: int):
    def run(batches):
        seen: set = set()               # repeated rows give one set a task
        for b in (p for x in batches for p in _parts(x)):
            sets = shingle_sets(b.column(0), n)
            if len(seen) > SEEN:
                seen.clear()
            sets = list({c: s for s in sets if (c := class_of(s)) not in seen}.values())
            seen.update(map(class_of, sets))
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([sketch(s) for s in sets], pa.binary())],
                ["cls", "n", "tokens", "sketch"])
    return run


def _far(x, y, num: int, den: int):
    """The most elements in which similar sets of these sizes differ."""
    return x + y - 2 * -(-(num * (x + y)) // (num + den))


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _blocks(num: int, den: int, best: bool):
    """Rows sorted by (leader, i, side): holds side 0 of one block, streams side 1; yields
    pairs in different components that the sketches do not rule out, of each streamed row the
    likeliest only if ``best``.  Two rows that both visit every block are compared in one of them."""
    def run(batches):
        key, held, by_width = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack([b.column(i).to_numpy() for i in range(2)], 1)
            side = b.column(2).to_numpy()
            cls, comp, n = (b.column(i).to_numpy() for i in (3, 4, 5))
            stays = b.column(6).to_numpy(zero_copy_only=False)
            sk = b.column(7).to_pylist()
            change = np.flatnonzero((g[1:] != g[:-1]).any(1) | (side[1:] != side[:-1])) + 1
            left, right = [], []
            for lo, hi in zip([0, *change], [*change, b.num_rows]):
                if key != (k := tuple(g[lo])):
                    key, held, by_width = k, [], None
                part = (cls[lo:hi], comp[lo:hi], n[lo:hi], stays[lo:hi], sk[lo:hi])
                if side[lo] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if by_width is None:
                    hc, hp, hn, ht = (np.concatenate([x[i] for x in held]) for i in range(4))
                    hs = [s for x in held for s in x[4]]
                    words = np.array([len(s) // 8 for s in hs])
                    by_width = [(w, at, _matrix(hs, at)) for w in np.unique(words) for at in [np.flatnonzero(words == w)]]
                for i in range(hi - lo):
                    c, p, m, _, s = (x[i] for x in part)
                    s = np.frombuffer(s, U)
                    ok = (hp != p) & (ht | (hc < c)) & (hn * den >= m * num) & (hn * num <= m * den)
                    hits = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                    for w, at, some in by_width:
                        at, some = at[ok[at]], some[ok[at]]
                        if len(at):
                            bits = _bits(_folded(some, min(w, len(s))), _folded(s, w))
                            near = bits <= _far(hn[at], m, num, den)
                            hits.append((at[near], bits[near]))
                    at, bits = map(np.concatenate, zip(*hits))
                    if best and len(at):
                        at = at[[bits.argmin()]]
                    left.append(hc[at])
                    right.append(np.full(len(at), c))
            if left and sum(map(len, left)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])
    return run


def _unlikely(num: int, den: int):
    """Pairs with both sketches -> those not ruled out."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (b.column(i).to_pylist() for i in (4, 5))
            wx, wy = (np.array([len(s) // 8 for s in side]) for side in (x, y))
            bits = np.zeros(b.num_rows, np.int64)
            for i, j in {*zip(wx.tolist(), wy.tolist())}:
                at = np.flatnonzero((wx == i) & (wy == j))
                bits[at] = _bits(_folded(_matrix(x, at), j), _folded(_matrix(y, at), i))
            ok = bits <= _far(b.column(2).to_numpy(), b.column(3).to_numpy(), num, den)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok))
    return run


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets are similar, by exact intersection; only their sets are moved."""
    pairs = written(pairs, "pairs")
    used = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    if pairs.count() <= BROADCAST_ROWS:         # checked size; else the join shuffles
        used = F.broadcast(used)
    own = sets.join(used, "cls", "left_semi")
    x = own.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    y = own.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("both"),
                                                 (F.size("x") + F.size("y")).cast("long").alias("sum"))
    return both.where(F.col("both") * den >= (F.col("sum") - F.col("both")) * num).select("a", "b").distinct()


def _sketched(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    x = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    y = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    some = pairs.join(x, "a").join(y, "b").where(f"na * {den} >= nb * {num} and nb * {den} >= na * {num}")
    return some.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_unlikely(num, den), "a long, b long")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, num: int = 85, den: int = 100,
            crowd: int = CROWD, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, edges, found): ``members`` has id, key (hash of id and text), th (hash of the text), n (set
    size) and cls for every row; ``edges`` links classes, enough of them to join all that are connected by pairs with
    num / den Jaccard similarity or more, and only such pairs; ``found`` names the component
    of every class that has an edge, as (cls, comp)."""
    if not 0 < 2 * num <= 2 * den or num * RATIO < den:
        raise ValueError("the similarity must lie between 1 / RATIO and 1")
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                      F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    members = written(src.mapInArrow(_classes(n), f"id {kind}, key long, th long, n long, cls long"), "members")
    index = (src.select("text").mapInArrow(_entries(n, num, den), "key long, cls long, tag int")
             .repartition("key").sortWithinPartitions("key", "cls"))
    shared = written(index.mapInArrow(_shared(crowd), "key long, cls long, tag int, leader long, hot boolean"), "shared")

    # a similar pair shares all units but H, less the empty segments that its level allows: drop
    # the entries of sets that share fewer at their band and level
    shared = shared.select("key", "cls", "leader", "hot", F.shiftright("tag", 25).alias("band"),
                           F.shiftright("tag", 23).bitwiseAND(3).alias("level"), F.shiftright("tag", 22).bitwiseAND(1).alias("weak"),
                           F.col("tag").bitwiseAND((1 << 22) - 1).alias("seg"))
    plans = [allocation(k, num, den) for k in range(48)]
    exact, slack = (F.get(F.array(*[F.lit(p[i]) for p in plans]), F.col("band")) for i in (0, 2))
    price = F.when(F.col("seg") < exact, 1).otherwise(2)
    enough = (shared.groupBy("cls", "band", "level", "seg").agg(F.max("hot").alias("hot"), F.max("weak").alias("weak"))
              .groupBy("cls", "band", "level").agg(F.sum(price).alias("units"), F.sum(F.when(F.col("hot"), price).otherwise(0)).alias("crowded"),
                                                   F.max("weak").alias("weak"))
              .where((F.col("level") == LEVELS) | (F.col("units") > slack - F.floor(slack / 2)))
              .select("cls", "band", "level", ((F.col("weak") == 1) | (F.col("crowded") > slack - F.floor(slack / 2))).alias("need")))
    shared = written(shared.join(enough, ["cls", "band", "level"]).select("key", "cls", "leader", "hot", "need"), "entries")

    # the sets of the classes that are left, from one row each
    reps = members.join(shared.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.min("key").alias("key")).select("key")
    reps = written(reps, "reps")
    if reps.count() <= BROADCAST_ROWS:          # checked size; else the join shuffles
        reps = F.broadcast(reps)
    texts = src.select("key", "text").join(reps, "key", "left_semi")
    sets = written(texts.select("text").mapInArrow(_sets(n), "cls long, n long, tokens array<long>, sketch binary"), "sets")

    # first: each class with the leader it shares most entries with
    closest = (shared.where("cls <> leader").groupBy("cls", "leader").agg(F.count("*").alias("c"))
               .groupBy("cls").agg(F.max_by("leader", F.struct("c", "leader")).alias("b")).withColumnRenamed("cls", "a"))
    edges = written(_verified(_sketched(closest, sets, num, den), sets, num, den), "edges")
    found = components(edges).toDF("cls", "comp")

    # then: pairs of other components, from entries and rare elements with few sets ...
    rare = _rare(shared.where("hot and need").select("cls").distinct(), sets, num, den, crowd)
    few = shared.where("not hot").select("key", "cls").union(rare.where("not hot").select("key", "cls"))
    few = few.join(found, "cls", "left").select("key", "cls", F.coalesce("comp", "cls").alias("comp"))
    mixed = few.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    few = few.join(mixed, "key", "left_semi")
    pairs = (few.toDF("key", "a", "ca").join(few.toDF("key", "b", "cb"), "key").where("a < b and ca <> cb").select("a", "b").distinct())
    pairs = _sketched(pairs, sets, num, den)

    # ... and from elements with many: twice each row's best candidate only, which joins most
    # of what belongs together, then all that is left
    hot = written(rare.where("hot").select("leader", "cls").distinct(), "hot")
    for step, best in enumerate((True, True, False)):
        some = _crowded(hot, sets, found, num, den, block, best)
        some = some if step else some.union(pairs).distinct()
        more = written(_verified(some, sets, num, den), "more")
        if more.take(1):
            edges = edges.union(more)
            found = _joined(found, more)
    return members, edges, found


def _matched(rows: DataFrame, counts: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` with the columns of ``counts``, one row a key, of the keys it has.  Keys that hold more than one
    row in HEAVY of all (``n``) are fewer than HEAVY, so they are broadcast; the rest is an
    equi join without hot keys."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    heavy = F.col(n) * HEAVY > total
    some = rows.join(F.broadcast(counts.where(heavy)), key, "left")
    return some.where(F.col(n).isNotNull()).unionByName(
        some.where(F.col(n).isNull()).select(rows.columns).join(counts.where(~heavy), key))


def _rare(need: DataFrame, sets: DataFrame, num: int, den: int, crowd: int) -> DataFrame:
    """``need``'s sets by the elements of their prefix that another prefix holds too: (key, cls, leader, hot),
    ``leader`` the first set with the element, ``hot`` whether more than ``crowd`` have it."""
    need = written(need, "need")
    if need.count() <= BROADCAST_ROWS:          # checked size; else the join shuffles
        need = F.broadcast(need)
    elements = sets.join(need, "cls", "left_semi").select("cls", "n", F.explode("tokens").alias("key"))
    counts = written(elements.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    # elements of one set only come first in the order and meet nothing: they only shorten the prefix
    mine = (_matched(elements, counts, "key", "c").groupBy("cls", "n").agg(F.sort_array(F.collect_list(F.struct("c", "key"))).alias("e"))
            .withColumn("length", F.expr(f"greatest(0L, size(e) - (n * {num} + {den - 1}) div {den} + 1)").cast("int")))
    prefix = written(mine.select("cls", F.explode(F.slice("e", F.lit(1), F.col("length"))).alias("e")).select("e.key", "cls"), "prefix")
    met = written(prefix.groupBy("key").agg(F.count("*").alias("k"), F.min("cls").alias("leader")).where("k > 1"), "met")
    return written(_matched(prefix, met, "key", "k").select("key", "cls", "leader", (F.col("k") > crowd).alias("hot")), "rare")


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` after the edges ``more``: the components of components, one edge for each edge."""
    ends = more.select(F.col("a").alias("cls")).union(more.select("b")).distinct()
    nodes = written(found.join(ends, "cls", "full").select("cls", F.coalesce("comp", "cls").alias("comp")), "nodes")
    a, b = nodes.toDF("a", "ca"), nodes.toDF("b", "cb")
    up = components(more.join(a, "a").join(b, "b"), "ca", "cb").toDF("comp", "top")
    return written(nodes.join(up, "comp", "left").select("cls", F.coalesce("top", "comp").alias("comp")), "found")


def _crowded(hot: DataFrame, sets: DataFrame, found: DataFrame, num: int, den: int, block: int, best: bool) -> DataFrame:
    """Pairs of different components in the groups of crowded elements that sketches allow."""
    group = hot.join(found, "cls", "left").select("leader", "cls", F.coalesce("comp", "cls").alias("comp"))
    crowds = (group.groupBy("leader", "comp").agg(F.count("*").alias("c")).groupBy("leader").agg(
        F.sum("c").alias("size"), F.count("*").alias("comps"), F.max_by("comp", F.struct("c", "comp")).alias("main"))
        .where("comps > 1").select("leader", "size", "main", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    group = (_matched(group, written(crowds, "crowds"), "leader", "size").join(sets.select("cls", "n", "sketch"), "cls")
             .withColumn("stays", F.col("comp") == F.col("main")))
    held = F.array(F.struct(F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("i"), F.lit(0).alias("side")))
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(j.alias("i"), F.lit(1).alias("side")))
    dealt = (group.withColumn("x", F.explode(F.when(F.col("stays"), held).otherwise(F.concat(held, visits))))
             .select("leader", "x.i", "x.side", "cls", "comp", "n", "stays", "sketch")
             .repartition("leader", "i").sortWithinPartitions("leader", "i", "side"))
    return (dealt.mapInArrow(_blocks(num, den, best), "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per document: id, key, n_shingles, component_id (the smallest id reachable) and
    ``component``, a name of the group that also rows with null ids have (null: empty set)."""
    members, _, found = similar(docs, id_col, text_col, **params)
    classes = members.where("n > 0").groupBy("cls").agg(F.min("id").alias("first")).join(found, "cls", "left") \
        .select("cls", "first", F.coalesce("comp", "cls").alias("comp"))
    low = classes.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = classes.join(low, "comp").select("cls", "component_id", F.col("comp").alias("component"))
    return (members.join(named, "cls", "left")
            .select(F.col("id").alias(id_col), "key", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id"), "component"))
