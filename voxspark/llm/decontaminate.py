r"""Benchmark decontamination by spaced-seed hashing.

A text's tokens are its lower-cased runs of letters and digits; in scripts written without
spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every letter is one.  A mask picks some
positions of a short stretch and ignores the others; the picked tokens of every stretch
are hashed, in benchmark items and documents alike, and equal hashes are joined.  Around a
hit the two texts are compared token by token on the hit's diagonal.  A document holds
part of an item when ``window`` tokens in a row of one line up with as many of the other
and at most ``errors`` differ.  The masks are such that every such stretch has a hit
(``lossless`` proves it for the window and errors given), so the result does not depend on
them.

The benchmark's seeds are joined in blocks of bounded size, each a broadcast of at most
``BLOCK_SEEDS`` rows, so documents are never shuffled to find hits; only hits are.

With ``short``, items of fewer tokens than the window are searched for as well, each with all of its
tokens as the window: ``errors`` in the same proportion, rounded down, where an unbroken run of
``LEAST_MASK`` tokens is sure to be left (the mask), else none, with the whole item as the mask.

Defined results: without ``short``, items of fewer tokens than the window are not searched for;
null and empty texts and items without tokens hold nothing; repeated rows and items give the result of one; a null id is an id.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, written

WINDOW, ERRORS = 13, 2
MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 3, 8, 9, 10))
LEAST_MASK = 4
BLOCK_SEEDS = 2_000_000
BROADCAST_ROWS = 200_000


def lossless(masks=MASKS, window: int = WINDOW, errors: int = ERRORS) -> bool:
    """Does some mask, somewhere in the window, avoid every choice of ``errors`` positions?"""
    places = [{o + i for i in m} for m in masks for o in range(window - m[-1])]
    return all(any(not p.intersection(bad) for p in places) for bad in combinations(range(window), errors))


def short_plan(tokens: int, window: int = WINDOW, errors: int = ERRORS) -> tuple[tuple, int]:
    """(mask, errors) for an item of fewer tokens than the window; the mask is lossless."""
    few = errors * tokens // window
    if tokens // (few + 1) < LEAST_MASK:
        few = 0
    return tuple(range(tokens // (few + 1))), few       # of few + 1 equal runs one is without error


_DENSE = "".join(rf"\p{{Is{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
_TOKEN = rf"([\p{{L}}\p{{N}}&&[{_DENSE}]]|[\p{{L}}\p{{N}}&&[^{_DENSE}]]+)"


def token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TOKEN), F.lit(1))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def seeds(h: Column, number: int, mask: tuple) -> Column:
    """The mask's hash at every position of the token hashes ``h`` where it fits."""
    last = F.size(h) - 1 - mask[-1]
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(number), *[F.get(h, i + o) for o in mask]))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                     F.col(text_col).alias("text"))


def hits(docs: DataFrame, items: DataFrame, masks=MASKS, window: int = WINDOW) -> DataFrame:
    """Distinct ``(key, item, diagonal)``: equal seeds of a document and an item.  ``docs`` has
    ``key`` and ``h``; ``items`` has ``item`` and ``g`` (token hashes)."""
    def exploded(df: DataFrame, name: str, h: str, at: str) -> DataFrame:
        # a row per mask first, so that no row holds more than one array of seeds
        return (df.select(name, F.explode(F.array(*[seeds(F.col(h), n, m) for n, m in enumerate(masks)])).alias("ss"))
                .select(name, F.posexplode("ss").alias(at, "s")))

    own = exploded(items, "item", "g", "q").distinct()
    blocks = max(1, -(-own.count() // BLOCK_SEEDS))
    doc_seeds = exploded(docs, "key", "h", "p")
    found = None
    for b in range(blocks):
        block = own.where(F.pmod(F.xxhash64("s"), F.lit(blocks)) == b)
        part = (doc_seeds.join(F.broadcast(block), "s")
                .select("key", "item", (F.col("p") - F.col("q")).alias("diagonal")))
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def aligned(h: Column, g: Column, diagonal: Column, window: int | Column, errors: int | Column) -> tuple[Column, Column]:
    """(equal tokens on the diagonal, starts in the item of the stretches that count)."""
    same = F.transform(F.sequence(F.lit(0), F.size(g) - 1),
                       lambda i: F.when((diagonal + i >= 0) & (F.get(h, diagonal + i) == F.get(g, i)), 1).otherwise(0))
    first = F.greatest(F.lit(0), -diagonal)
    last = F.least(F.size(g), F.size(h) - diagonal) - window
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return same, F.filter(starts, lambda s: F.aggregate(F.slice(F.col("same"), s + 1, window), F.lit(0),
                                                        lambda a, x: a + x) >= window - errors)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", masks=MASKS, window: int = WINDOW,
             errors: int = ERRORS, short: bool = False) -> DataFrame:
    """One row per document and item that overlap: ``key`` (hash of id and text, to find the row
    again), ``id``, ``item``, ``matched`` (equal tokens on the best diagonal), ``item_tokens`` and
    ``first_token`` (position of the first stretch in the document, from 0)."""
    if not lossless(masks, window, errors):
        raise ValueError("these masks can miss a stretch of this window and errors")
    keyed = _keyed(docs, id_col, text_col)
    items = (benchmark.select(F.col(item_col).alias("item"), token_hashes(F.col(item_text)).alias("g"))
             .where(F.size("g") >= (1 if short else window)))
    hashed = keyed.select("key", token_hashes(F.col("text")).alias("h"))
    found = hits(hashed, items.where(F.size("g") >= window), masks, window)
    width, few = F.lit(window), F.lit(errors)
    if short:
        lengths = [r.n for r in items.where(F.size("g") < window).select(F.size("g").alias("n")).distinct().collect()]  # < window rows
        plans = {n: short_plan(n, window, errors) for n in sorted(lengths)}
        width = F.least(F.size("g"), F.lit(window))
        few = F.lit(errors)
        for n, (mask, e) in plans.items():
            few = F.when(F.size("g") == n, e).otherwise(few)
        # items by mask: a document's seeds of one mask are joined once
        for mask in sorted({m for m, _ in plans.values()}):
            these = [n for n, (m, _) in plans.items() if m == mask]
            found = found.unionByName(hits(hashed, items.where(F.size("g").isin(these)), (mask,), window))
    found = written(found.distinct() if short else found, "hits")
    keys = found.select("key").distinct()
    if found.count() <= BROADCAST_ROWS:         # checked size; else the join shuffles
        keys = F.broadcast(keys)
    held = keyed.join(keys, "key", "left_semi").select("key", "id", token_hashes(F.col("text")).alias("h")).dropDuplicates(["key"])
    rows = held.join(found, "key").join(items, "item")
    same, starts = aligned(F.col("h"), F.col("g"), F.col("diagonal"), width, few)
    return (rows.withColumn("same", same).withColumn("starts", starts).where(F.size("starts") > 0)
            .select("key", "id", "item", F.aggregate("same", F.lit(0), lambda a, x: a + x).alias("matched"),
                    F.size("g").alias("item_tokens"), (F.col("diagonal") + F.get("starts", F.lit(0))).alias("first"))
            .groupBy("key", "id", "item")
            .agg(F.max("matched").cast("long").alias("matched"), F.max("item_tokens").cast("long").alias("item_tokens"),
                 F.min("first").cast("long").alias("first_token")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the rows that overlap an item, all their columns kept, whatever their names."""
    (at,) = free_names(docs, "key")
    bad = overlaps(docs, benchmark, id_col, text_col, **params).select(F.col("key").alias(at)).distinct()
    here = F.xxhash64(docs[id_col], docs[text_col])
    return docs.join(bad, here == F.col(at), "left_anti")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS h FROM documents),
g AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS g FROM benchmark),
dt AS (SELECT doc_id, len(h) AS nh, unnest(h) AS t, unnest(range(len(h))) AS p FROM d),
gt AS (SELECT item_id, len(g) AS ng, unnest(g) AS t, unnest(range(len(g))) AS q FROM g WHERE len(g) >= 13),
lined AS (SELECT doc_id, item_id, nh, ng, p - q AS diagonal, list(q) AS qs, count(*) AS matched
          FROM dt JOIN gt USING (t) GROUP BY ALL HAVING count(*) >= 11),
starts AS (SELECT *, unnest(range(greatest(0, -diagonal), least(ng, nh - diagonal) - 12)) AS s FROM lined),
good AS (SELECT * FROM starts WHERE len(list_filter(qs, lambda x: x >= s AND x < s + 13)) >= 11)
SELECT doc_id, item_id, CAST(max(matched) AS BIGINT) AS matched, CAST(max(ng) AS BIGINT) AS item_tokens,
       CAST(min(diagonal + s) AS BIGINT) AS first_token
FROM good GROUP BY doc_id, item_id
"""
