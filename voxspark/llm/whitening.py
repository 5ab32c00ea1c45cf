"""Embedding whitening by spectrum slicing.

The covariance of all vectors is gathered in two passes over the rows (sums, then products of
entries centred at the whole number nearest the mean; the rest, at most a half, is taken off
exactly), in whole numbers, so that it is the same in any order of tasks.  The driver gets one
matrix of dimension by dimension, whatever the number of rows.

Its leading eigenvalues are isolated one by one: the number of negative pivots of an LDL^T
factorisation of V - s*I counts the eigenvalues below s (Sylvester's law of inertia), so
bisection over s gives an interval that holds the k-th eigenvalue alone.  Rayleigh quotient
iteration then converges cubically, and counts on both sides of its result certify that it is
number k.  Eigenvalues that no shift tells apart at double precision (a repeated eigenvalue)
are taken together: a basis of their common space, found by block inverse iteration.

Defined results: rows whose vector is null, empty or holds null, NaN or infinite entries are left
out; so are vectors whose length differs from the most frequent one (the longer one on a tie).
Null and repeated ids are kept, a row each.  Components whose eigenvalue is zero at double
precision (``dim * eps`` of the largest) can't be scaled and are not returned: one row, or equal rows,
give no result rows, an empty table none either.  An entry too large for a long raises an error.  Only
the two named columns are read, so other columns, whatever their names, change nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, written

OFFSET, SCALE = 1_000_000, 64.0
#: Largest sum of products that doubles hold without rounding.
EXACT = 2.0 ** 53


# ---------------------------------------------------------------- eigenvalues of one matrix
def inertia(a: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix: signs of the blocks of its LDL^T
    factorisation with complete pivoting (1x1 and 2x2 blocks, Bunch and Parlett's rule)."""
    a = a.copy()
    n, k, below = len(a), 0, 0
    alpha = (1 + 17 ** 0.5) / 8                       # fixed value of the rule: bounds the growth of entries
    while k < n:
        s = a[k:, k:]
        diag = np.abs(np.diagonal(s))
        p = int(diag.argmax())
        off = np.abs(np.tril(s, -1))
        i, j = divmod(int(off.argmax()), n - k)
        if diag[p] >= alpha * off[i, j]:
            if diag[p] == 0:
                return below                          # all that is left is zero
            s[[0, p]] = s[[p, 0]]
            s[:, [0, p]] = s[:, [p, 0]]
            below += s[0, 0] < 0
            s[1:, 1:] -= np.outer(s[1:, 0] / s[0, 0], s[0, 1:])
            k += 1
        else:
            for x, y in ((0, j), (1, i)):             # j < i, so the first swap leaves row i alone
                s[[x, y]] = s[[y, x]]
                s[:, [x, y]] = s[:, [y, x]]
            below += 1                                # such a block has one eigenvalue of each sign
            s[2:, 2:] -= s[2:, :2] @ np.linalg.solve(s[:2, :2], s[:2, 2:])
            k += 2
    return below


class Spectrum:
    """Eigenvalues of a symmetric matrix by counts."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.n = len(v)
        self.top = float(np.abs(v).sum(axis=1).max()) if self.n else 0.0        # no eigenvalue lies beyond
        self.least = self.n * np.finfo(float).eps * self.top                   # what rounding may change
        self.seen: dict[float, int] = {}

    def above(self, s: float) -> int:
        """Eigenvalues greater than ``s``."""
        if s not in self.seen:
            self.seen[s] = inertia(s * np.eye(self.n) - self.v)
        return self.seen[s]

    def interval(self, k: int) -> tuple[float, float, int, int]:
        """(low, high, a, b): eigenvalues a+1 to b, counted from the largest, lie between; k is
        one of them.  b = a + 1 unless they are equal at double precision."""
        lo, hi = -self.top - self.least, self.top + self.least
        for s, c in self.seen.items():
            if c >= k:
                lo = max(lo, s)
            else:
                hi = min(hi, s)
        while self.above(lo) - self.above(hi) > 1 and hi - lo > 4 * self.least:
            mid = (lo + hi) / 2
            if self.above(mid) >= k:
                lo = mid
            else:
                hi = mid
        return lo, hi, self.above(hi), self.above(lo)


def _solve(v: np.ndarray, s: float, x: np.ndarray, least: float) -> np.ndarray:
    """Direction of (V - s*I)^-1 x; where s is an eigenvalue to the last bit, a few roundings beside it."""
    for shift in (s, s + least, s - least, s + 3 * least, s - 3 * least):
        try:
            y = np.linalg.solve(v - shift * np.eye(len(v)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y / np.abs(y).max()
    raise ArithmeticError("no shift near an eigenvalue can be solved for")


def _pair(sp: Spectrum, k: int, lo: float, hi: float) -> tuple[float, np.ndarray]:
    """The eigenpair of the k-th eigenvalue, the only one between ``lo`` and ``hi``: a few steps of
    inverse iteration at the middle, then Rayleigh quotient iteration.  Where counts beside the
    result don't certify it as number k, the interval is halved by counts and it begins again."""
    rng = np.random.default_rng(sp.n)
    while True:
        x = rng.standard_normal(sp.n)
        for _ in range(3):
            x = _solve(sp.v, (lo + hi) / 2, x, sp.least)
            x /= np.linalg.norm(x)
        best = (np.inf, 0.0, x)
        for _ in range(12):
            e = float(x @ sp.v @ x)
            left = float(np.linalg.norm(sp.v @ x - e * x))
            if left >= best[0]:
                break                                 # no better: at the limit of doubles
            best = (left, e, x)
            x = _solve(sp.v, e, x, sp.least)
            x /= np.linalg.norm(x)
        left, e, x = best
        near = 4 * sp.least
        if left <= sp.least and sp.above(e + near) < k <= sp.above(e - near):
            return e, x
        if hi - lo <= near:
            raise ArithmeticError(f"eigenvalue {k} not certified")
        mid = (lo + hi) / 2
        if sp.above(mid) >= k:
            lo = mid
        else:
            hi = mid


def _space(sp: Spectrum, lo: float, hi: float, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``m`` eigenvalues that are equal at double precision."""
    x = np.random.default_rng(m).standard_normal((sp.n, m))
    for _ in range(6):
        x, _ = np.linalg.qr(_solve(sp.v, (lo + hi) / 2, x, sp.least))
    mid = (lo + hi) / 2
    return np.full(m, mid), x


def leading(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    sp = Spectrum(v)
    if not sp.top:                                    # nothing varies: all eigenvalues are zero
        return np.zeros(min(count, sp.n)), np.eye(sp.n)[:, :count]
    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < min(count, sp.n):
        k = len(values) + 1
        lo, hi, a, b = sp.interval(k)
        if b - a == 1:
            e, x = _pair(sp, k, lo, hi)
            found, basis = np.array([e]), x[:, None]
        else:
            found, basis = _space(sp, lo, hi, b - a)
            found, basis = found[k - 1 - a:], basis[:, k - 1 - a:]
        if vectors:                                   # neighbours that lie close lean on each other: take that off
            held = np.stack(vectors, 1)
            for _ in range(2):
                basis = basis - held @ (held.T @ basis)
            basis, _ = np.linalg.qr(basis)
        for e, x in zip(found, basis.T):
            x = x / np.linalg.norm(x)
            values.append(float(e))
            vectors.append(x if x[np.abs(x).argmax()] > 0 else -x)
    keep = min(count, sp.n)
    return np.array(values[:keep]), np.stack(vectors[:keep], 1) if keep else np.empty((sp.n, 0))


# ---------------------------------------------------------------- passes over the rows
def whole(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, x)``: entries as whole numbers, floor(64 * c) + 1,000,000; unusable rows left out."""
    c = F.col(vector)
    usable = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    def entry(e):
        e = F.lit(SCALE) * e.cast("double")
        fits = F.when(F.abs(e) < 2.0 ** 62, F.floor(e)).otherwise(F.raise_error("an entry is too large for a whole number").cast("long"))
        return (fits + OFFSET).cast("long")
    return df.where(usable).select(F.col(id).alias("id"), F.transform(c, entry).alias("x"))


def _rows(batch, dim: int):
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_row(mats, n: int):
    """One row (i, n, sums) per row of a task's matrix: bounded by the dimension."""
    import pyarrow as pa
    return pa.RecordBatch.from_pydict({"i": pa.array(range(len(mats)), pa.int32()), "n": pa.array([n] * len(mats), pa.int64()),
                                       "p": pa.array([[str(e) for e in r] for r in mats], pa.list_(pa.string()))})


def _total(parts: DataFrame, kind: str) -> tuple[int, list]:
    """Sums of the tasks' matrices, entry by entry, added up by Spark before they reach the
    driver; ``decimal(38,0)`` keeps whole numbers exact."""
    flat = parts.select("i", "n", F.posexplode("p").alias("j", "e")).groupBy("i", "j").agg(
        F.sum(F.col("e").cast(kind)).alias("e"), F.sum("n").alias("n"))
    rows = flat.groupBy("i").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("j", "e"))).alias("r")).collect()
    rows.sort(key=lambda r: r.i)
    return (rows[0].n if rows else 0), [[x.e for x in r.r] for r in rows]


def _sums(vectors: DataFrame, dim: int) -> tuple[int, list[int]]:
    def run(batches):
        n, s = 0, np.zeros(dim, dtype=object)
        for b in batches:
            x = _rows(b, dim)
            n += len(x)
            for k in range(0, len(x), 1 << 20):       # 2^20 longs of up to 2^42 stay below 2^62
                part = x[k:k + (1 << 20)]
                big = len(part) and max(abs(int(part.max())), abs(int(part.min()))) >= 1 << 42
                s = s + (part.astype(object) if big else part).sum(axis=0)
        if n:
            yield _by_row([s], n)
    n, rows = _total(vectors.mapInArrow(run, "i int, n long, p array<string>"), "decimal(38,0)")
    return n, [int(e) for e in rows[0]] if rows else []


def _products(vectors: DataFrame, dim: int, at: list[int]) -> list[list[int]]:
    """Sums over rows of (x - at)(x - at)^T, exact: blocks of rows short enough that doubles don't
    round; where even one row is too large for that, Python's whole numbers."""
    def run(batches):
        centre = np.array(at, dtype=np.int64)
        n, g = 0, np.zeros((dim, dim), dtype=object)
        for b in batches:
            y = _rows(b, dim) - centre
            n += len(y)
            most = float(np.abs(y).max()) if len(y) else 0.0
            step = int(EXACT / max(most * most, 1.0))
            if step < 1:
                o = y.astype(object)
                g = g + o.T.dot(o)
                continue
            z = y.astype(np.float64)
            for k in range(0, len(z), step):
                part = z[k:k + step]
                g = g + (part.T @ part).astype(np.int64).astype(object)
        if n:
            yield _by_row(g, n)
    _, rows = _total(vectors.mapInArrow(run, "i int, n long, p array<string>"), "decimal(38,0)")
    return [[int(e) for e in r] for r in rows]


def fit(vectors: DataFrame, components: int = 32) -> dict:
    """Model of whole-number vectors (see ``whole``): n, sums, eigenvalues, eigenvectors, trace."""
    dims = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not dims:
        return {"n": 0, "dim": 0, "sums": [], "values": np.empty(0), "vectors": np.empty((0, 0)), "trace": 0.0}
    dim = dims[0].d
    rows = vectors.where(F.size("x") == dim)
    n, s = _sums(rows, dim)
    at = [(2 * e + n) // (2 * n) for e in s]
    g = _products(rows, dim, at)
    rest = [e - n * m for e, m in zip(s, at)]
    # n * sum(y y^T) - rest rest^T is n times the sum of products centred at S / n
    v = np.array([[(n * g[i][j] - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)], dtype=np.float64)
    values, basis = leading(v, components)
    good = values > dim * np.finfo(float).eps * max(float(values[0]) if len(values) else 0.0, np.finfo(float).tiny)
    return {"n": n, "dim": dim, "sums": s, "values": values[good], "vectors": basis[:, good], "trace": float(np.trace(v))}


def apply(vectors: DataFrame, model: dict) -> DataFrame:
    """``(id, deviation, w)``: the exact sum of (n*x - S)^2 and the whitened row, an array."""
    from decimal import Decimal

    import pyarrow as pa
    n, dim, k = model["n"], model["dim"], len(model["values"])
    sums, scaled = model["sums"], model["vectors"] / np.sqrt(model["values"])
    id_type = vectors.schema["id"].dataType

    def run(batches):
        s = np.array(sums, dtype=object)
        narrow = all(abs(e) < 1 << 62 for e in sums)
        for b in batches:
            x = _rows(b, dim)
            most = max(abs(int(x.max())), abs(int(x.min()))) if len(x) else 0
            if narrow and n * most < 1 << 62:
                d = n * x - s.astype(np.int64)
                far = float(np.abs(d).max()) if len(x) else 0.0
                # longs where no sum can pass them, Python's whole numbers elsewhere
                dev = (d * d).sum(axis=1) if dim * far * far < 2.0 ** 62 else (d.astype(object) ** 2).sum(axis=1)
            else:
                d = n * x.astype(object) - s
                dev = (d * d).sum(axis=1)
            w = (d.astype(np.float64) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([Decimal(int(e)) for e in dev], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, pa.array(w.ravel()))], ["id", "deviation", "w"])

    rows = vectors.where(F.size("x") == dim)
    return rows.mapInArrow(run, f"id {id_type.simpleString()}, deviation decimal(38,0), w array<double>")


def identity_error(white: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on
    the rows: means first, then products of centred entries."""
    at = white.select(F.posexplode("w").alias("j", "e")).groupBy("j").agg((F.sum("e") / n).alias("m")).collect()
    means = np.array([r.m for r in sorted(at, key=lambda r: r.j)])

    def run(batches):
        g, m = np.zeros((k, k)), 0
        for b in batches:
            w = b.column("w").flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - means
            g += w.T @ w
            m += len(w)
        if m:
            yield _by_row(g, m)
    _, rows = _total(white.select("w").mapInArrow(run, "i int, n long, p array<string>"), "double")
    return float(np.abs(np.array(rows, dtype=np.float64) / n - np.eye(k)).max())


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """A row per usable vector and component: the id, ``component`` from 1, ``n``, ``deviation``
    (a decimal: its size grows with n squared), ``whitened``, ``explained`` and ``identity_error``."""
    spark = df.sparkSession
    importable(spark)
    vectors = written(whole(df, id, vector), "vectors")
    model = fit(vectors, components)
    out = "`component` int, `n` long, `deviation` decimal(38,0), `whitened` double, `explained` double, `identity_error` double"
    if not len(model["values"]):
        return spark.createDataFrame([], f"`{id}` {df.schema[id].dataType.simpleString()}, {out}")
    n, k = model["n"], len(model["values"])
    white = written(apply(vectors, model), "whitened")
    error = identity_error(white, n, k)
    share = F.array(*[F.lit(float(e / model["trace"])) for e in model["values"]])
    return (white.select(F.col("id").alias(id), "deviation", F.posexplode("w").alias("j", "whitened"))
            .select(id, (F.col("j") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("j")).alias("explained"), F.lit(error).alias("identity_error")))
