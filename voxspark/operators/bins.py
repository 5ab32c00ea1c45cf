"""Duration and token bins, bucket assignment and batch plans
(WIN9-WIN14, FLT7, FLT8, AGG8, AGG9, JOIN6, PRJ13, SCL16, SCL17).

The bin estimator walks rows sorted by length and opens a new bin when the running
sum since the last bin start *exceeds* an equal share (a resetting cumulative sum,
SURVEY H-1).  That is not a window function, but its boundaries are found in a constant number
of jobs:

1. rows are reduced to a histogram of cells (equal keys, with a row count) - lengths
   repeat, so this is far smaller than the data and its size is bounded by the number
   of distinct lengths, not by the row count;
2. range-partitioned prefix sums give each cell its rows-before ``R0`` and
   mass-before ``P0``;
3. a stretch of cells is summed up by those of its rows that can open a bin at all.  A bin passes its
   share by less than the row before its end, and rows are in rising order of weight, so the
   k-th boundary has a mass-before in ``(k * share, k * (share + w)]``, w its own weight: about k
   rows for each k, whatever the number of rows (``resetting_boundaries`` has the bound).
   Summaries are merged by putting their rows together (an aggregate, combined map-side), and
   the walk from boundary to boundary runs over the merged summary inside Spark, one row per
   group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .index import running_sums, with_index

FOUND = "array<struct<i:bigint,s:double,v:double>>"


# ------------------------------------------------------------------ boundary search
def resetting_boundaries(cells: DataFrame, group: str, w: str, value: str, max_bins: int) -> DataFrame:
    """All boundaries of the resetting cumulative sum per group: a row ``(group, found)``, ``found``
    an array of (row index ``i``, mass before it ``s``, value ``v``).

    ``cells`` holds ``group, share, c, R0, P0, <w>, <value>`` (prefixes within the group, in walk
    order, which must be the rising order of ``w``).  A cell of ``c`` equal rows can hold
    the k-th boundary only if some row of it has a mass-before P with
    ``k * share < P <= k * (share + w)``.  For rows lighter than share / K (K the number of bins)
    these windows are disjoint and a window holds at most ``k * (1 + log(share / w))`` rows, as
    the mass before a row grows by a factor ``1 + 1/k`` or the weight stays; heavier rows
    number at most K * K in all.  So a summary is bounded by K and the range of weights."""
    weight = F.col(w)
    # a shade wider than exact: rounding may add a candidate, never lose one
    low = F.greatest(F.ceil(F.col("P0") / (F.col("share") + weight) * (1 - 1e-9)), F.lit(1))
    high = F.least(F.floor((F.col("P0") + F.col("c") * weight) / F.col("share") * (1 + 1e-9)), F.lit(max_bins))
    near = cells.where((F.col("share") > 0) & (low <= high))
    cell = F.struct("R0", "P0", "c", weight.cast("double").alias("w"), F.col(value).cast("double").alias("v"))
    merged = near.groupBy(group).agg(F.first("share").alias("share"), F.array_sort(F.collect_list(cell)).alias("near"))

    def step(state, _):
        """From the mass before the last boundary to the next one: inside the first cell whose
        last row passes the share, its first row that does."""
        left = F.col("share") + state["s"]
        hits = F.filter("near", lambda x: x["P0"] + (x["c"] - 1) * x["w"] - state["s"] > F.col("share"))

        def row(x):
            k = F.floor((left - x["P0"]) / x["w"]) + 1
            # the division may round up: the row before must not pass the share
            k = F.when((k >= 1) & (x["P0"] + (k - 1) * x["w"] - state["s"] > F.col("share")), k - 1).otherwise(k)
            k = F.when(x["P0"] - state["s"] > F.col("share"), F.lit(0).cast("long")).otherwise(k)
            return F.struct((x["R0"] + k).alias("i"), (x["P0"] + k * x["w"]).alias("s"), x["v"].alias("v"))

        rows = F.transform(F.slice(hits, 1, 1), row)
        # nothing passes the share any more: an infinite mass ends the walk
        return F.struct(F.coalesce(F.get(rows, 0)["s"], F.lit(float("inf"))).alias("s"), F.concat(state["found"], rows).alias("found"))

    start = F.struct(F.lit(0.0).alias("s"), F.array().cast(FOUND).alias("found"))
    return merged.select(group, F.aggregate(F.sequence(F.lit(1), F.lit(max_bins)), start, step, lambda st: st["found"]).alias("found"))


def _cells(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Histogram cells in ``keys`` order with exclusive prefixes R0 (rows) and P0
    (sum of ``weight``), written to the shared folder."""
    h = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    h = h.withColumn("_mass", F.col(weight).cast("double") * F.col("c"))
    h = running_sums(h, keys, {"_cr": "c", "_cm": "_mass"})
    return written(h.withColumn("R0", F.col("_cr") - F.col("c")).withColumn("P0", F.col("_cm") - F.col("_mass"))
                   .drop("_cr", "_cm", "_mass"), "cells")


def _duration_boundaries(cells: DataFrame, num_buckets: int) -> tuple[list, int, float | None]:
    """Boundaries ``(row index, length)`` of equal-mass bins over ``cells`` (``num_buckets`` numbers at
    the most), the number of rows and the longest length."""
    n, total, longest = cells.agg(F.sum("c"), F.sum(F.col("d") * F.col("c")), F.max("d")).first()
    if not n:
        return [], 0, None
    walk = cells.withColumn("g", F.lit(0)).withColumn("share", F.lit(total / num_buckets))
    rows = resetting_boundaries(walk, "g", "d", "d", num_buckets + 1).collect()
    return [(x.i, x.v) for r in rows for x in r.found], n, longest


# ------------------------------------------------------------------ 1-D bins (WIN9)
def duration_bins(df: DataFrame, num_buckets: int, dur: str = "duration") -> list[float]:
    """WIN9: equal-mass duration bins: the durations of the rows that open bins
    2..n (lengths sorted ascending; a bin closes once its sum exceeds total/n)."""
    if num_buckets < 2:
        raise ValueError("num_buckets must be > 1")
    cells = _cells(df.select(F.col(dur).cast("double").alias("d")), ["d"], "d")
    return [v for _, v in _duration_boundaries(cells, num_buckets)[0]]


# ------------------------------------------------------------------ 2-D bins (WIN10)
def _tps(t: Column, d: Column) -> Column:
    """Tokens per second; a zero-length row has infinite TPS (as numpy gives)."""
    return F.when(d > 0, t.cast("double") / d).otherwise(F.lit(float("inf")))


def duration_bins_2d(df: DataFrame, num_buckets: int, num_subbuckets: int,
                     threshold: float = 4.0, dur: str = "duration", tok: str = "tokens",
                     max_duration: float = math.inf, legacy: bool = False):
    """WIN10 (+FLT7, AGG9): 2-D (duration, tokens) bins.

    Returns ``(bins, stats)``: ``bins`` a DataFrame ``bin_id, bucket, max_duration,
    max_tokens, max_tps`` in list order; ``stats`` per bucket token range, TPS cap and
    outliers.  ``legacy=True`` leaves the longest row out of the last bucket's token
    statistics, as the reference loop does (D-7)."""
    if num_buckets < 2:
        raise ValueError("num_buckets must be > 1")
    rows = df.select(F.col(dur).cast("double").alias("d"), F.col(tok).cast("long").alias("t"))
    cells = _cells(rows, ["d", "t"], "d")
    found, n, dmax = _duration_boundaries(cells, num_buckets)
    starts = [0] + [i for i, _ in found]
    last_end = n - 1 if legacy else n
    top = dmax if math.isinf(max_duration) or dmax is None else max_duration
    maxdur = [v for _, v in found] + [top]

    # split cells at bucket starts (a handful of literals, bounded by num_buckets)
    cuts = F.array(*[F.lit(int(s)) for s in starts[1:]] or [F.lit(-1)]).cast("array<long>")
    lo, hi = F.col("R0"), F.col("R0") + F.col("c")
    inner = F.filter(cuts, lambda x: (x > lo) & (x < hi))
    piece_starts = F.concat(F.array(lo), inner)
    piece_ends = F.concat(inner, F.array(hi))
    pieces = (cells.withColumn("_p", F.explode(F.arrays_zip(piece_starts.alias("a"), piece_ends.alias("b"))))
              .select("d", "t", F.col("_p.a").alias("a"), F.col("_p.b").alias("b")))
    start_arr = F.array(*[F.lit(int(s)) for s in starts]).cast("array<long>")
    pieces = pieces.withColumn("bucket", (F.size(F.filter(start_arr, lambda x: x <= F.col("a"))) - 1)
                               .cast("int"))
    pieces = (pieces.withColumn("b", F.least(F.col("b"), F.lit(int(last_end))))
              .withColumn("c", F.col("b") - F.col("a")).filter(F.col("c") > 0)
              .withColumn("tps", _tps(F.col("t"), F.col("d"))))

    # FLT7: z-score of TPS per bucket (population sigma, upper side only; sigma 0 keeps all); the
    # moments are of finite TPS, a zero-length row is an outlier
    finite = F.col("tps") < F.lit(math.inf)
    mom = pieces.filter(finite).groupBy("bucket").agg((F.sum(F.col("tps") * F.col("c")) / F.sum("c")).alias("mu"))
    dev = pieces.join(F.broadcast(mom), "bucket", "left")
    sig = dev.filter(finite).groupBy("bucket").agg(
        F.sqrt(F.sum(F.pow(F.col("tps") - F.col("mu"), 2) * F.col("c")) / F.sum("c")).alias("sigma"))
    z = F.try_divide(F.col("tps") - F.col("mu"), F.col("sigma"))
    tagged = written(dev.join(F.broadcast(sig), "bucket", "left")
                     .withColumn("keep", finite & F.coalesce((F.col("sigma") == 0) | (z <= threshold), F.lit(True)))
                     .select("bucket", "t", "c", "tps", "keep"), "tagged")
    keep = F.col("keep")
    limit = F.array(*[F.lit(x).cast("double") for x in maxdur])
    stats = tagged.groupBy("bucket").agg(
        F.min(F.when(keep, F.col("t"))).alias("min_tokens"),
        F.max(F.when(keep, F.col("t"))).alias("max_tokens"),
        F.max(F.when(keep, F.col("tps"))).alias("max_tps"),
        F.sum(F.when(~keep, F.col("c")).otherwise(0)).alias("outliers"),
        F.min(F.when(~keep, F.col("tps"))).alias("min_outlier_tps"),
        F.max(F.when(~keep, F.col("tps"))).alias("max_outlier_tps"),
        F.sum("c").alias("rows")).withColumn("max_duration", F.get(limit, F.col("bucket")))

    # token sub-bins: histogram of kept tokens per bucket, walked in token order.  A
    # bucket's token histogram is bounded by the number of distinct token counts.
    th = (tagged.filter("keep").groupBy("bucket", "t").agg(F.sum("c").alias("c"))
          .withColumn("_m", F.col("t").cast("double") * F.col("c")))
    wb = Window.partitionBy("bucket").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    th = (th.withColumn("R0", F.sum("c").over(wb) - F.col("c"))
            .withColumn("P0", F.sum("_m").over(wb) - F.col("_m"))
            .withColumn("share", F.sum("_m").over(Window.partitionBy("bucket")) / num_subbuckets))
    sub = resetting_boundaries(th, "bucket", "t", "t", num_subbuckets + 1)
    # one row per bucket; a bucket with nothing kept has no bins
    ends = F.concat(F.coalesce(F.transform("found", lambda x: x["v"].cast("long")), F.array().cast("array<long>")), F.array("max_tokens"))
    bins = stats.where("max_tokens is not null").join(F.broadcast(sub), "bucket", "left")
    bins = bins.select("bucket", "max_duration", F.posexplode(ends).alias("_j", "max_tokens"), "max_tps")
    # buckets x sub-buckets rows
    place = F.row_number().over(Window.orderBy("bucket", "_j")) - 1
    return bins.select(place.alias("bin_id"), "bucket", "max_duration", "max_tokens", "max_tps"), stats


# ------------------------------------------------------------------ assignment (JOIN6)
def assign_bin_1d(df: DataFrame, bounds: list[float], dur: str = "duration") -> DataFrame:
    """JOIN6, 1-D: bins are exclusive upper bounds ``[0,b0) [b0,b1) ...``; the last is
    closed so the longest row fits; past it -> null.  ``bounds`` is a short list."""
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    d = F.col(dur)
    idx = F.size(F.filter(arr, lambda b: b <= d))
    last = len(bounds) - 1
    return df.withColumn("bin_id", F.when(idx < len(bounds), idx)
                         .when(d == F.lit(float(bounds[-1])), F.lit(last)).cast("int"))


def assign_bin_2d(df: DataFrame, bins: list[tuple[float, int]], dur: str = "duration",
                  tok: str = "tokens") -> DataFrame:
    """JOIN6, 2-D: first bin in list order with ``d <= max_d`` and ``tok <= max_tok``;
    none -> null.  Bins (<= buckets x sub-buckets pairs) are literals, so the lookup is
    a codegen'd expression, no join."""
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(d)).alias("d"), F.lit(int(t)).alias("t"))
                    for i, (d, t) in enumerate(bins)])
    hits = F.filter(arr, lambda b: (F.col(dur) <= b["d"]) & (F.col(tok) <= b["t"]))
    return df.withColumn("bin_id", F.get(hits, 0)["i"].cast("int"))


def within_tps(caps: list[float], dur: str = "duration", tok: str = "tokens") -> Column:
    """True when a row's tokens/second is within its bin's cap; null when unassigned."""
    arr = F.array(*[F.lit(float(c)) for c in caps])
    cap = F.get(arr, F.col("bin_id"))
    return F.when(F.col("bin_id").isNotNull(), _tps(F.col(tok), F.col(dur)) <= cap)


def filter_tps(assigned: DataFrame, caps: list[float], dur: str = "duration",
               tok: str = "tokens") -> DataFrame:
    """FLT8: drop training rows whose tokens/second exceed their bin's cap."""
    return assigned.filter(F.coalesce(within_tps(caps, dur, tok), F.lit(False)))


# ------------------------------------------------------------------ other bin forms
def static_buckets(lo: float, hi: float, n: int) -> list[tuple[float, float]]:
    """WIN11: ``n`` ranges of equal width from ``lo`` on, lower ends included, upper ends not; the
    last reaches 1e-5 further, so that ``hi`` fits."""
    width = (hi - lo) / n
    lower = [lo + k * width for k in range(n)]
    return [(x, x + width + (1e-5 if k == n - 1 else 0.0)) for k, x in enumerate(lower)]


def assign_static_bucket(df: DataFrame, ranges: list[tuple[float, float]],
                         dur: str = "duration") -> DataFrame:
    """WIN11: bucket = first range with ``a <= d < b``; outside -> null (dropped)."""
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                    for i, (a, b) in enumerate(ranges)])
    hits = F.filter(arr, lambda r: (F.col(dur) >= r["a"]) & (F.col(dur) < r["b"]))
    return df.withColumn("bucket", F.get(hits, 0)["i"].cast("int"))


# The percentiles of the description.
PERCENTILES = {"p01": 0.01, "p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9,
               "p95": 0.95, "p99": 0.99, "p995": 0.995, "p999": 0.999}


def describe_duration(df: DataFrame, dur: str = "duration", exact: bool = True) -> DataFrame:
    """AGG8: count, mean, sample std, min, 11 percentiles (linear), max of the lengths that are
    not null.  Percentiles are looked up by rank in the histogram's running counts, exact and
    spread over tasks, however many distinct lengths there are; ``exact=False`` takes
    ``percentile_approx`` in one pass."""
    if not exact:
        d = F.col(dur)
        return df.agg(F.count(d).alias("count"), F.avg(d).alias("mean"), F.stddev_samp(d).alias("std"), F.min(d).alias("min"),
                      *[F.percentile_approx(d, p, 100000).alias(name) for name, p in PERCENTILES.items()], F.max(d).alias("max"))
    cells = _cells(df.select(F.col(dur).cast("double").alias("d")).filter("d is not null"), ["d"], "d")
    n, total = cells.agg(F.sum("c"), F.sum(F.col("d") * F.col("c"))).first()
    n = n or 0
    mean = total / n if n else None
    d, c, r0 = F.col("d"), F.col("c"), F.col("R0")

    def at(rank: int) -> Column:
        return F.max(F.when((r0 <= F.lit(rank)) & (r0 + c > F.lit(rank)), d))

    cols = []
    for name, p in PERCENTILES.items():
        pos = p * max(n - 1, 0)
        lo = int(pos)
        cols.append((at(lo) + (at(min(lo + 1, max(n - 1, 0))) - at(lo)) * F.lit(pos - lo)).alias(name))
    std = F.sqrt(F.sum(F.pow(d - F.lit(mean), 2) * c) / F.lit(float(n - 1))) if n > 1 else F.lit(None)
    return cells.agg(F.coalesce(F.sum(c), F.lit(0)).alias("count"), F.lit(mean).cast("double").alias("mean"),
                     std.cast("double").alias("std"), F.min(d).alias("min"), *cols, F.max(d).alias("max"))


def bin_limits(bins: DataFrame, ratio: int = 12, rate: int = 16000) -> DataFrame:
    """PRJ13: input/output lengths per bin: seconds -> samples at ``rate`` (round half
    even, as Python's ``round``); 1-D output length ``ceil(ratio * seconds)``; a 2-D
    bin carries its token bound."""
    seconds = F.col("max_duration")
    out = bins.withColumn("input_samples", F.bround(seconds * rate).cast("long"))
    if "max_tokens" in bins.columns:
        return out.withColumn("output_len", F.col("max_tokens").cast("long"))
    return out.withColumn("output_len", F.ceil(seconds * ratio).cast("long"))


def parse_bins(c: Column) -> Column:
    """SCL16: ``[[d,t],...]`` -> array of pairs, else ``[d,...]`` -> 1-element pairs;
    ``is_2d`` tells which."""
    two = F.from_json(c, "array<array<double>>")
    one = F.from_json(c, "array<double>")
    is_2d = two.isNotNull() & (F.size(two) > 0) & F.forall(two, lambda p: F.size(p) == 2)
    return F.when(is_2d, F.struct(F.lit(True).alias("is_2d"), two.alias("bins"))).otherwise(
        F.struct(F.lit(False).alias("is_2d"), F.transform(one, lambda x: F.array(x)).alias("bins")))


def format_bins(bins: DataFrame, *extra: Column) -> DataFrame:
    """SCL17: one row: ``[[d.ddd,n],...]`` and the TPS caps with two decimals, in bin
    order (a small, bounded list: buckets x sub-buckets); ``extra`` aggregates ride
    along in the same pass."""
    # Python formats the exact binary value (ties to even); bround first so exact ties
    # agree (Java's formatter alone rounds them up)
    item = F.struct("bin_id", F.format_string("[%.3f,%d]", F.bround("max_duration", 3),
                                              "max_tokens").alias("b"),
                    F.format_string("%.2f", F.bround("max_tps", 2)).alias("p"))
    agg = bins.agg(F.array_sort(F.collect_list(item)).alias("xs"), *extra)
    return agg.select(*[c for c in agg.columns if c != "xs"],
        F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["b"]), ","), F.lit("]")).alias("bins"),
        F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["p"]), ","), F.lit("]")).alias("max_tps"))


# ------------------------------------------------------------------ batch plans
def plan_batches(assigned: DataFrame, batch_sizes: list[int], order: list[str]) -> DataFrame:
    """WIN12: rows of each bin cut into batches of that bin's size, in ``order``.
    The position inside a bin uses the global index (no per-bin window, so a bin
    holding a third of the rows is still spread over many tasks)."""
    sizes = F.array(*[F.lit(int(b)) for b in batch_sizes])
    pos = with_index(assigned.filter(F.col("bin_id").isNotNull()), ["bin_id", *order], col="_g", group=1,
                     pos="pos_in_bin").drop("_g")
    bs = F.element_at(sizes, F.col("bin_id") + 1)
    return pos.withColumn("batch", F.floor(F.col("pos_in_bin") / bs).cast("long"))


def _fill(eff, limit: float, tot: float):
    """Batch of every row of a chunk, counted from the one that is open with ``tot`` at its start."""
    import numpy as np
    out = np.empty(len(eff), dtype=np.int64)
    b = 0
    for j, e in enumerate(eff.tolist()):
        if tot > 0 and tot + e > limit:
            b += 1
            tot = 0.0
        tot += e
        out[j] = b
    return out


def _first_close(eff, limit: float, tot: float):
    """(first row that closes the open batch, -1 for none; the open sum where there is none)"""
    for j, e in enumerate(eff):
        if tot > 0 and tot + e > limit:
            return j, tot
        tot += e
    return -1, tot


def _chains(eff, limit: float):
    """For each row at which the batch open at a chunk's start can close first: the batches
    closed up to the chunk's end and the sum open there.  An open sum of zero closes last, so
    those rows end where it does."""
    import numpy as np
    last, _ = _first_close(eff.tolist(), limit, 0.0)
    k = len(eff) if last < 0 else last + 1
    tot, n = np.zeros(k), np.zeros(k, dtype=np.int64)
    for j, e in enumerate(eff.tolist()):
        m = min(j, k)
        grown = tot[:m] + e
        over = (tot[:m] > 0) & (grown > limit)
        tot[:m] = np.where(over, e, grown)
        n[:m] += over
        if j < k:
            tot[j], n[j] = e, 1
    return n, tot


def _joined(chunks, limit: float):
    """Summary of a stretch of chunks from theirs, in order: what a close at each row of its head leads
    to at the stretch's end.  The head goes on into the next chunk as long as nothing closes
    for sure; joining summaries of summaries gives the same as joining all chunks."""
    import numpy as np
    head, closed, left, sure = np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0), False
    for h, n, o in chunks:
        tot, grown, done = left.copy(), closed.copy(), np.zeros(len(left), dtype=bool)
        end, count = tot.copy(), grown.copy()
        for j, e in enumerate(h.tolist()):
            now = ~done & (tot > 0) & (tot + e > limit)
            end[now], count[now] = o[j], grown[now] + n[j]
            done |= now
            tot = tot + e
            if done.all():
                break
        end[~done] = tot[~done]
        left, closed = end, count
        if not sure:
            head, left, closed = np.concatenate([head, h]), np.concatenate([left, o]), np.concatenate([closed, n])
            sure = _first_close(h.tolist(), limit, 0.0)[0] >= 0
    return head, closed, left


def plan_batches_capped(assigned: DataFrame, cap: float = 360.0, quadratic: float = 15.0,
                        buffer: int = 20000, order: list[str] | None = None,
                        dur: str = "duration", fan: int = 64) -> DataFrame:
    """WIN13: per bin, close a batch before the running sum of effective durations
    ``d + d^2/quadratic`` would pass ``cap``.  ``batch`` counts from 0 in every bin, which is
    one run of batches; ``batch_in_chunk`` counts from the one open where the chunk starts.
    Bins are worked on in chunks of ``buffer`` rows, on which ``batch`` does not depend.  Every
    chunk is first reduced to its head (the rows up to the first that closes a batch whatever
    is open) and to what follows from a close at each of them, and ``fan`` chunks to one such summary
    of them all.  These, one for ``fan * buffer`` rows, are streamed in order to give each
    stretch its open sum and batch number; then stretches are walked chunk by chunk and chunks filled,
    all side by side.  No task holds a whole bin; sums are added row by row as in one run."""
    order = order or [dur, "utt_id"]
    pos = with_index(assigned.filter(F.col("bin_id").isNotNull()), ["bin_id", *order], col="_g", group=1,
                     pos="pos_in_bin").drop("_g")
    eff = F.col(dur) + F.col(dur) * F.col(dur) / F.lit(float(quadratic))
    chunk = F.floor(F.col("pos_in_bin") / buffer).cast("long")
    small = written(pos.select("bin_id", chunk.alias("chunk"), "pos_in_bin", eff.alias("eff")), "lengths")
    limit = float(cap)
    summary = "bin_id int, {} long, head array<double>, closed array<long>, open array<double>"

    def heads(pdf):
        import pandas as pd
        v = pdf.sort_values("pos_in_bin")["eff"].to_numpy()
        n, tot = _chains(v, limit)
        return pd.DataFrame({"bin_id": pdf["bin_id"].iloc[:1].to_numpy(), "chunk": pdf["chunk"].iloc[:1].to_numpy(),
                             "head": [v[:len(n)]], "closed": [n], "open": [tot]})

    def stretch(pdf):
        import pandas as pd
        pdf = pdf.sort_values("chunk")
        head, closed, left = _joined(pdf[["head", "closed", "open"]].itertuples(index=False, name=None), limit)
        return pd.DataFrame({"bin_id": pdf["bin_id"].iloc[:1].to_numpy(), "part": pdf["part"].iloc[:1].to_numpy(),
                             "head": [head], "closed": [closed], "open": [left]})

    def walk(rows, tot, b):
        """(open sum, batch number) before each summary, from those before the first."""
        out = []
        for head, closed, left in rows:
            out.append((tot, b))
            j, end = _first_close(head.tolist(), limit, tot)
            tot, b = (end, b) if j < 0 else (float(left[j]), b + int(closed[j]))
        return out, tot, b

    def carried(frames):
        import pandas as pd
        now, tot, b = None, 0.0, 0
        for pdf in frames:
            rows = []
            for bin_id, part, *one in pdf.itertuples(index=False):
                if bin_id != now:
                    now, tot, b = bin_id, 0.0, 0
                before, tot, b = walk([one], tot, b)
                rows.append((bin_id, part, *before[0]))
            yield pd.DataFrame(rows, columns=["bin_id", "part", "tot", "first"])

    def inside(pdf):
        pdf = pdf.sort_values("chunk")
        rows, _, _ = walk(pdf[["head", "closed", "open"]].itertuples(index=False, name=None), float(pdf["tot"].iloc[0]), int(pdf["first"].iloc[0]))
        return pdf.assign(tot=[t for t, _ in rows], first=[b for _, b in rows])[["bin_id", "chunk", "tot", "first"]]

    def fill(pdf):
        pdf = pdf.sort_values("pos_in_bin")
        got = _fill(pdf["eff"].to_numpy(), limit, float(pdf["tot"].iloc[0]))
        return pdf.assign(batch_in_chunk=got, batch=got + pdf["first"])[["bin_id", "chunk", "pos_in_bin", "batch_in_chunk", "batch"]]

    chunks = written(small.groupBy("bin_id", "chunk").applyInPandas(heads, summary.format("chunk"))
                     .withColumn("part", F.floor(F.col("chunk") / fan).cast("long")), "chunks")
    parts = chunks.groupBy("bin_id", "part").applyInPandas(stretch, summary.format("part"))
    state = (parts.repartition("bin_id").sortWithinPartitions("bin_id", "part")
             .mapInPandas(carried, "bin_id int, part long, tot double, first long"))
    state = chunks.join(state, ["bin_id", "part"]).groupBy("bin_id", "part").applyInPandas(
        inside, "bin_id int, chunk long, tot double, first long")
    batches = small.join(state, ["bin_id", "chunk"]).groupBy("bin_id", "chunk").applyInPandas(
        fill, "bin_id int, chunk long, pos_in_bin long, batch_in_chunk long, batch long")
    return pos.join(batches, ["bin_id", "pos_in_bin"])


def merge_bins(profile: DataFrame) -> DataFrame:
    """WIN14: merge adjacent 1-D bins with equal batch size, keeping the larger bound
    (gaps and islands; the profile is a short list, one row per bin)."""
    w = Window.orderBy("bound")
    g = profile.withColumn("_new", F.when(F.lag("batch_size").over(w) == F.col("batch_size"), 0)
                           .otherwise(1))
    g = g.withColumn("_grp", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy("_grp").agg(F.max("bound").alias("bound"),
                                 F.first("batch_size").alias("batch_size")).drop("_grp")
