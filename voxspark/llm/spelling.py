"""Spelling variants by dense prefix-suffix tiling.

Two different words are one edit apart (one code point inserted, deleted or replaced) exactly
when the lengths of their common prefix and common suffix add up to the longer length minus
one or more.  Words are laid out as padded matrices of code points, once from the left and
once from the right, and blocks of them are compared pair by pair of blocks.

Which blocks meet: cut the positions of the longer word (length M) into ``pieces`` parts.  The
first difference lies in one part, so the two words share all before that part (counted from
the left) and all behind it (counted from the right).  A tile holds the words of lengths M and
M - 1 with the same M, part and shared ends; every pair one edit apart meets in the tile of
its first difference and is taken there alone.  Nothing is capped: a tile of more than
``block`` words is cut into blocks and all its block pairs are compared, in tasks of their own;
small tiles share a matrix, in which words of different tiles are masked.

Defined results: a null text has no words; a null id counts as the empty string in the hash;
repeated rows count each; very long texts and words are taken whole (a matrix is cut by cells,
not rows); an empty table gives an empty table; only the named columns are read, so other
columns, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable, written

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Cells (pairs times width) compared at once, and rows of a matrix shared by small tiles.
CELLS, SHARED = 1 << 21, 64


def lower_az(c: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does it for texts of ASCII alone, faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(docs: DataFrame, id: str = "doc_id", text: str = "text", drop_every: int = 97, least_len: int = 5,
          least_n: int = 3) -> DataFrame:
    """``(word, n)``: the runs of letters of all texts, each losing one code point where
    ``drop_every`` divides the hash of id and run; words of ``least_len`` code points and
    ``least_n`` occurrences or more."""
    runs = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("i"),
                       F.explode(F.regexp_extract_all(lower_az(F.col(text)), F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("i", F.lit(":"), "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(drop_every)) == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= least_len)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n))


def _tiles(vocab: DataFrame, pieces: int) -> DataFrame:
    """Every word once for each part of the two longer lengths it can take part in."""
    size, x = F.length("word"), F.col("x")
    m = (size + F.floor(x / pieces)).cast("int")
    part = F.pmod(x, F.lit(pieces))
    rows = vocab.withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(2 * pieces - 1)))).select(
        "word", "n", m.alias("longer"), part.cast("int").alias("part"))
    lo = F.floor(F.col("longer") * F.col("part") / pieces).cast("int")
    hi = F.floor(F.col("longer") * (F.col("part") + 1) / pieces).cast("int")
    behind = F.col("longer") - F.col("hi")
    return (rows.withColumn("lo", lo).withColumn("hi", hi).where("lo < hi")
            .withColumn("ends", F.xxhash64(F.substring(F.col("word"), F.lit(1), F.col("lo")),
                                           F.substring(F.col("word"), F.length("word") - behind + 1, behind))))


def _matrix(ws: list[str], width: int, pad: int):
    """Code points, left-aligned; the last column is ``pad`` so that every row of a matrix
    padded by 0 differs there from every row of one padded by 1."""
    import numpy as np
    out = np.zeros((len(ws), width + 1), dtype=np.uint32)
    out[:, :width] = np.array(ws, dtype=f"U{width}").view(np.uint32).reshape(len(ws), width)
    out[:, width] = pad
    return out


def _shared(a, b):
    """Length of the common start of every row of ``a`` with every row of ``b``."""
    import numpy as np
    got = np.empty((len(a), len(b)), dtype=np.int64)
    step = max(1, CELLS // (len(b) * a.shape[1]))
    for k in range(0, len(a), step):
        got[k:k + step] = (a[k:k + step, None, :] == b[None, :, :]).argmin(axis=2)
    return got


def _edits(a: list[str], b: list[str], rows_a, rows_b, same: bool):
    """Index pairs of ``a`` and ``b`` in one tile that are one edit apart with their first
    difference in the tile's part; ``rows_*`` hold (tile, longer, lo, hi) per word."""
    import numpy as np
    width = max(map(len, a + b))
    la, lb = np.array([len(w) for w in a]), np.array([len(w) for w in b])
    least, most = np.minimum.outer(la, lb), np.maximum.outer(la, lb)
    start = np.minimum(_shared(_matrix(a, width, 0), _matrix(b, width, 1)), least)
    end = np.minimum(_shared(_matrix([w[::-1] for w in a], width, 0), _matrix([w[::-1] for w in b], width, 1)), least)
    ok = ((start + end >= most - 1) & (rows_a[:, None, 0] == rows_b[None, :, 0]) & (most == rows_a[:, None, 1])
          & (start >= rows_a[:, None, 2]) & (start < rows_a[:, None, 3]))
    return np.nonzero(np.triu(ok, 1) if same else ok)


def _compare(frames):
    """Rows of block pairs, sorted by tile and pair -> pairs one edit apart."""
    import numpy as np
    import pandas as pd

    def found(group):
        """One block pair of a large tile, or several small tiles."""
        ws, ns = group["word"].tolist(), group["n"].to_numpy()
        info = np.stack([group["run"].to_numpy(), group["longer"].to_numpy(), group["lo"].to_numpy(), group["hi"].to_numpy()], 1)
        mine = (group["own"] == group["one"]).to_numpy()
        if mine.all():
            i, j = _edits(ws, ws, info, info, True)
        else:
            left, right = np.nonzero(mine)[0], np.nonzero(~mine)[0]
            if not len(left):
                return None
            i, j = _edits([ws[k] for k in left], [ws[k] for k in right], info[left], info[right], False)
            i, j = left[i], right[j]
        if not len(i):
            return None
        return pd.DataFrame({"a": [ws[k] for k in i], "an": ns[i], "b": [ws[k] for k in j], "bn": ns[j]})

    rest, base = None, 0
    keys = ["longer", "part", "ends", "one", "two"]
    for pdf in frames:
        if not len(pdf):
            continue
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        change = (pdf[keys].to_numpy()[1:] != pdf[keys].to_numpy()[:-1]).any(axis=1)
        pdf["run"] = base + np.concatenate([[0], np.cumsum(change)])
        cuts = np.concatenate([[0], np.nonzero(change)[0] + 1])
        last, out, k = cuts[-1], [], 0
        ends = np.append(cuts[1:], len(pdf))
        pairs = (pdf["one"] != pdf["two"]).to_numpy()
        while k < len(cuts) - 1:                                  # the last run may go on in the next batch
            e = k + 1
            while e < len(cuts) - 1 and ends[e] - cuts[k] <= SHARED and not pairs[cuts[k]] and not pairs[cuts[e]]:
                e += 1
            if ends[e - 1] - cuts[k] > 1:
                out.append(found(pdf.iloc[cuts[k]:ends[e - 1]]))
            k = e
        out = [x for x in out if x is not None]
        if out:
            yield pd.concat(out, ignore_index=True)
        rest = pdf.iloc[last:].drop(columns="run")
        base = int(pdf["run"].iloc[-1])
    if rest is not None and len(rest) > 1:
        got = found(rest.assign(run=0))
        if got is not None:
            yield got


def near_pairs(vocab: DataFrame, pieces: int = 4, block: int = 512) -> DataFrame:
    """``(a, an, b, bn)``: every unordered pair of words of ``vocab`` (``word`` distinct, ``n``)
    one edit apart, once."""
    importable(vocab.sparkSession)
    keys = ["longer", "part", "ends"]
    tiles = _tiles(vocab, pieces)
    held = written(tiles.groupBy(*keys).agg(F.count("*").alias("c"), F.sum(F.length("word")).alias("cells")).where("c > 1")
                   .select(*keys, "c", F.least("c", F.ceil(F.greatest(F.col("c") / block, F.col("cells") / CELLS))).cast("int").alias("blocks")),
                   "tiles")
    tasks = int((held.agg(F.sum(F.col("c") * F.col("blocks"))).first()[0] or 0) // 50_000)
    tasks += int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = tiles.join(held, keys).withColumn("own", own).select("*", other)
    rows = rows.select(*keys, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "lo", "hi", "word", "n")
    at = [*keys, "one", "two"]
    return (rows.repartition(tasks, *at).sortWithinPartitions(*at)
            .mapInPandas(_compare, "a string, an long, b string, bn long"))


def forms(vocab: DataFrame, pairs: DataFrame, factor: int = 2, max_rounds: int = 64) -> DataFrame:
    """``word, form, root, n, n_near, form_n``.  A form has ``factor`` times its word's count or
    more, so chains never close and are as long as the logarithm of the largest count; their
    ends are found by pointer doubling, a join a round."""
    if factor < 2:
        raise ValueError("factor must be at least 2: chains of equal counts could close")
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("o"), F.col("bn").alias("c")),
                                          F.struct(F.col("b").alias("word"), F.col("a").alias("o"), F.col("an").alias("c")))).alias("p"))
    best = both.groupBy("p.word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("p.c")).alias("c"), F.col("p.o").alias("o"))).alias("best"))
    takes = -F.col("best.c") >= factor * F.col("n")
    table = written(vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.o")).alias("form"),
        F.when(takes, -F.col("best.c")).alias("form_n")), "forms")
    up = table.where("form is not null").select("word", F.col("form").alias("to"))
    for _ in range(max_rounds):
        nxt = up.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = written(up.join(nxt, "to", "left").select("word", F.coalesce("further", "to").alias("to"),
                                                         F.col("further").isNotNull().alias("moved")), "roots")
        up = step.select("word", "to")
        if not step.where("moved").limit(1).count():
            break
    else:
        raise RuntimeError(f"forms: chains not ended after {max_rounds} rounds")
    return table.join(up, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id: str = "doc_id", text: str = "text", pieces: int = 4, block: int = 512) -> DataFrame:
    """The words of all texts with their near words, forms and roots."""
    vocab = written(words(docs, id, text), "words")
    return forms(vocab, near_pairs(vocab, pieces, block))
