"""Near-duplicate vectors by spherical-cap filters with structured random product codes.

Unit vectors are rotated at random and cut into two blocks; each block has a code of random
directions, and a filter is a pair of them (codes squared filters).  The number of directions is the
root of the number of vectors that are compared with each other, counted per label and length
(``code_size``), so that a filter holds about one publisher at any size: a vector then meets about N^(1/3)
others on as many filters, where a fixed code would make it meet a fixed share of all.  List decoding finds
all filters whose inner product with a vector exceeds a bound: first the directions of one
block that can still reach it, then their partners.

A vector publishes itself on its best filter, and looks for others on every filter that
exceeds ``c * s - sigmas * sqrt(1 - c^2) * sqrt((1 - s^2) / (d - 1))`` with ``s`` its own best inner
product.  Of a pair with cosine c the one with the larger ``s`` is found by the other unless
the random rotation puts its best filter more than ``sigmas`` standard deviations off: below
3e-7 for five, for every pair, whatever the data and the size of the code.  (``sigmas=None`` takes the worst case
instead, which never misses, at some three times the rows.)

Filters are joined by dealing and sorting rows on (label, filter, block).  A crowded filter's
publishers are split into blocks of about ``block`` vectors, so a task holds one block and
streams the seekers; a seeker goes to every block of its filter.  Rows carry an 8-bit form of
the vector with its exact error, which rules pairs out soundly; what is left is verified in
double precision.  Equal vectors of a label are one class throughout.

Defined results: null labels, and vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; vectors of different length are not compared;
repeated ids count as one vector of their class each; a null id is an id, but a group takes its
name from the others if it has any; an empty table gives no rows.  Classes are named by a 64-bit
hash within; ids are brought in for the result only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, written

THRESHOLD, CODES, SIGMAS, BLOCK, SEED = 0.98, 64, 5.0, 1024, 20_240
#: Least and largest code: of a very large label a filter holds more publishers, in blocks as any crowded one.
LEAST_CODE, MOST_CODE = 16, 8192
BROADCAST_ROWS = 100_000

_codes: dict = {}


def codes(dim: int, n: int = CODES, seed: int = SEED) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rotation, unit directions of each block), the same in every process."""
    if (dim, n, seed) not in _codes:
        r = np.random.default_rng([seed, dim, n])
        rotation = np.linalg.qr(r.standard_normal((dim, dim)))[0]
        blocks = [r.standard_normal((n, len(b))) for b in np.array_split(np.arange(dim), min(2, dim))]
        _codes[(dim, n, seed)] = rotation, [b / np.linalg.norm(b, axis=1, keepdims=True) for b in blocks]
    return _codes[(dim, n, seed)]


def code_size(n: Column) -> Column:
    """Directions a block for ``n`` vectors: the power of two next above the root of ``n``."""
    two = F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(n.cast("double")))))
    return F.least(F.greatest(two, F.lit(float(LEAST_CODE))), F.lit(float(MOST_CODE))).cast("int")


def decode(x: np.ndarray, threshold: float = THRESHOLD, n: int = CODES, sigmas: float | None = SIGMAS,
           seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For unit rows ``x``: best filter, its inner product, and (row, filter) of all that exceed
    the row's bound."""
    dim = x.shape[1]
    rotation, blocks = codes(dim, n, seed)
    y = x @ rotation
    if len(blocks) == 1:
        blocks = [blocks[0], np.zeros((1, 0))]
    cut = blocks[0].shape[1]
    root = np.sqrt(2 if blocks[1].shape[1] else 1)
    a, b = y[:, :cut] @ blocks[0].T / root, y[:, cut:] @ blocks[1].T / root
    best = a.argmax(1) * n + b.argmax(1)
    s = a.max(1) + b.max(1)
    off = np.sqrt(1 - threshold ** 2) * np.sqrt(np.maximum(0, 1 - s ** 2))
    bound = threshold * s - (off if sigmas is None else np.minimum(off, sigmas * off / np.sqrt(max(1, dim - 1)))) - 1e-9
    row, first = np.nonzero(a + b.max(1)[:, None] >= bound[:, None])
    at, second = np.nonzero(a[row, first][:, None] + b[row] >= bound[row][:, None])
    return best, s, row[at], first[at] * n + second


def _sketch(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit rows, their scale, and the norm of what rounding lost."""
    scale = np.maximum(np.abs(x).max(1), 1e-300) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


ROLES = "label long, dim int, filter int, publishes boolean, vid long, s double, sketch binary, scale double, err double"


def roles(vectors: DataFrame, threshold: float, sigmas: float | None) -> DataFrame:
    """One row per vector that it publishes, and one per filter on which it seeks, by the code whose
    size the row names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in (big.slice(i, 512) for i in range(0, big.num_rows, 512)):
                ids, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
                values = b.column(2)
                ends = np.asarray(values.offsets)
                flat = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                sizes, wide = np.diff(ends), b.column(3).to_numpy()
                for dim, n in np.unique(np.stack([sizes, wide], 1), axis=0).tolist():
                    pick = np.nonzero((sizes == dim) & (wide == n))[0]
                    x = flat[ends[pick][:, None] + np.arange(dim)[None, :]]
                    x /= np.abs(x).max(1, keepdims=True)        # no overflow in the norm
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    best, s, row, found = decode(x, threshold, n, sigmas)
                    q, scale, err = _sketch(x)
                    row = np.concatenate([np.arange(len(pick)), row])
                    found = np.concatenate([best, found])
                    first = np.arange(len(row)) < len(pick)
                    raw = q[row].tobytes()
                    offs = pa.py_buffer((np.arange(len(row) + 1) * dim).astype(np.int32).tobytes())
                    sketch = pa.Array.from_buffers(pa.binary(), len(row), [None, offs, pa.py_buffer(raw)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(labels[pick][row].astype(np.int64)), pa.array(np.full(len(row), dim, np.int32)),
                         pa.array(found.astype(np.int32)), pa.array(first), pa.array(ids[pick][row]), pa.array(s[row]),
                         sketch, pa.array(scale[row]), pa.array(err[row])],
                        ["label", "dim", "filter", "publishes", "vid", "s", "sketch", "scale", "err"])

    return vectors.select("vid", "label", "vector", "codes").mapInArrow(run, ROLES)


def _near(threshold: float):
    """Streams sorted rows; holds one block of publishers; yields pairs not ruled out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []            # group, its publishers so far
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
            pub = b.column(4).to_numpy(zero_copy_only=False).astype(bool)
            vid, s, scale, err = (b.column(i).to_numpy() for i in (5, 6, 8, 9))
            sk = b.column(7)
            ends = np.frombuffer(sk.buffers()[1], np.int32)[sk.offset:sk.offset + b.num_rows + 1]
            data = np.frombuffer(sk.buffers()[2], np.int8)
            change = np.nonzero((keys[1:] != keys[:-1]).any(1) | (pub[1:] != pub[:-1]))[0] + 1
            left, right = [], []
            for lo, hi in zip([0, *change], [*change, b.num_rows]):
                if key != (k := tuple(keys[lo])):
                    key, held = k, []
                dim = k[1]
                part = (vid[lo:hi], s[lo:hi], data[ends[lo]:ends[hi]].reshape(hi - lo, dim).astype(np.float32), scale[lo:hi], err[lo:hi])
                if pub[lo]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(c) for c in zip(*held))]
                pv, ps, pq, pc, pe = held[0]
                for i in range(0, hi - lo, 2048):
                    uv, us, uq, uc, ue = (c[i:i + 2048] for c in part)
                    dot = (uq @ pq.T) * uc[:, None] * pc[None, :]
                    low = threshold - ue[:, None] - (1 + ue[:, None]) * pe[None, :] - 1e-6
                    first = (ps[None, :] > us[:, None]) | (ps[None, :] == us[:, None]) & (pv[None, :] > uv[:, None])
                    u, p = np.nonzero((dot >= low) & first)
                    left.append(uv[u])
                    right.append(pv[p])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])
    return run


def cosine(x: Column, y: Column) -> Column:
    """In double precision, components scaled by the largest first."""
    def unit(v: Column) -> Column:
        top = F.aggregate(v, F.lit(0.0), lambda a, e: F.greatest(a, F.abs(e.cast("double"))))
        return F.transform(F.array(top), lambda t: F.transform(v, lambda e: e.cast("double") / t))[0]

    def dot(v: Column, w: Column) -> Column:
        return F.aggregate(F.zip_with(v, w, lambda p, q: p * q), F.lit(0.0), lambda a, e: a + e)

    both = F.struct(unit(x).alias("x"), unit(y).alias("y"))
    return F.transform(F.array(both), lambda z: dot(z["x"], z["y"]) / F.sqrt(dot(z["x"], z["x"]) * dot(z["y"], z["y"])))[0]


def usable(v: Column) -> Column:
    sound = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & sound & F.exists(v, lambda e: e != 0), F.lit(False))


def sized(classes: DataFrame, n: int | None = None) -> DataFrame:
    """``classes`` with the size of their label's code, or ``n`` for all: one count per label and length."""
    if n is not None:
        return classes.withColumn("codes", F.lit(n))
    counts = classes.groupBy("label", F.size("vector").alias("dim")).agg(code_size(F.count("*")).alias("codes"))
    counts = written(counts, "codes")
    if counts.count() <= BROADCAST_ROWS:        # checked size; else the join shuffles
        counts = F.broadcast(counts)
    return classes.withColumn("dim", F.size("vector")).join(counts, ["label", "dim"]).drop("dim")


def links(classes: DataFrame, threshold: float = THRESHOLD, n: int | None = None, sigmas: float | None = SIGMAS,
          block: int = BLOCK) -> DataFrame:
    """Distinct pairs ``(a, b)`` of ids of ``classes`` (vid, label, vector) with cosine at or above
    the threshold; ``n`` fixes the size of all codes."""
    r = written(roles(sized(classes, n), threshold, sigmas), "roles")
    crowd = (r.where("publishes").groupBy("label", "dim", "filter").agg(F.count("*").alias("n"))
             .select("label", "dim", "filter", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = (r.join(crowd, ["label", "dim", "filter"])
             .withColumn("blk", F.explode(F.when(F.col("publishes"), F.array(F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")))
                                          .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
             .select("label", "dim", "filter", "blk", "publishes", "vid", "s", "sketch", "scale", "err")
             .repartition("label", "dim", "filter", "blk")
             .sortWithinPartitions("label", "dim", "filter", "blk", F.desc("publishes"), "vid"))
    near = dealt.mapInArrow(_near(threshold), "a long, b long")
    v = classes.select("vid", "vector")
    return (near.join(v.select(F.col("vid").alias("a"), F.col("vector").alias("x")), "a")
            .join(v.select(F.col("vid").alias("b"), F.col("vector").alias("y")), "b")
            .where(cosine(F.col("x"), F.col("y")) >= threshold)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, **params) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
    src = src.withColumn("cls", F.when(usable(F.col("vector")) & F.col("label").isNotNull(),
                                       F.sha2(F.to_json(F.struct("label", F.struct(F.col("vector")))), 256)))
    good = src.where("cls is not null")
    classes = written(good.groupBy("cls").agg(F.xxhash64("cls").alias("vid"), F.min("id").alias("low"), F.count("*").alias("size"), F.first("label").alias("label"),
                                              F.first("vector").alias("vector")), "classes")
    pairs = written(links(classes.select("vid", "label", "vector"), threshold, **params), "links")
    size = classes.select("vid", "size")
    both = pairs.union(pairs.select("b", "a")).toDF("vid", "other")
    degree = both.join(size.toDF("other", "n"), "other").groupBy("vid").agg(F.sum("n").alias("others"))
    found = components(pairs).toDF("vid", "component")
    lowest = written(found.join(classes.select("vid", "low"), "vid").groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    if lowest.count() <= BROADCAST_ROWS:        # checked size; else the join shuffles
        lowest = F.broadcast(lowest)
    found = found.join(lowest, "component").select("vid", "component_id")
    per_class = (classes.select("cls", "vid", "size", "low").join(degree, "vid", "left").join(found, "vid", "left")
                 .select("cls", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                         F.coalesce("component_id", "low").alias("component_id")))
    return (src.select("id", "cls").join(per_class, "cls", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
