"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the sources, in order of their names (null last), take the given weights in turn and
share ``share`` times all tokens; a source gets at most ``repeats`` times its own size, and what
that leaves over is shared by weight among the others, until none is above (``targets``).

Schedule: a mix of N equal-token blocks.  Van der Corput's points (the bits of 0, 1, 2, ...
mirrored behind the point) are mapped through the cumulative weights of the sources, which are
whole numbers of blocks, so that every source gets exactly its number of slots, and close to
its share of them in every stretch of the mix (``slots``).  Points beyond N are passed over.
Slots are ranked within each source.

Blocks: each source's documents stand in an order shuffled by a hash, anew for every repeat, and
this stream is cut into blocks of ``block`` tokens.  The r-th slot of a source takes its r-th
block; the last is cut where the target ends.  A source so takes its target, rounded to a
whole number, and no document is taken more than ``repeats`` times.

No source is gathered in one task: positions in a stream are sums over hash ranges of some
thousand rows plus a sum inside each; slots are ranked by stretches of the schedule the same way.
Everything is Spark expressions; the orders are hashes, so reruns agree.

Defined results: a null text has no tokens; null ids and sources are values like others; rows with
the same id, source and size are copies 0, 1, ... of each other; documents without tokens are
taken zero times; a source without tokens has the target zero; an empty table gives an empty
table; very long texts spread over as many blocks as they need; only the three named columns are
read, so other columns, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, REPEATS, BLOCK = 1.5, 2, 512
#: Rows of a hash range, slots of a stretch and copies of a row handled together.
RANGE, STRETCH, COPIES = 4096, 16_384, 4096
#: Sources whose table is broadcast; counted, beyond it the joins are salted.
BROADCAST_SOURCES, BROADCAST_BYTES, SALTS = 100_000, 8 << 20, 64


def sizes(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(id, source, size, part, copies)``: equal rows together, at most ``COPIES`` a row, so that
    no group of copies has to stay in one task."""
    rows = docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    same = rows.groupBy("id", "source", "size").agg(F.count("*").alias("c"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / COPIES)))
    return same.withColumn("part", part).select(
        "id", "source", "size", "part", F.least(F.lit(COPIES).cast("long"), F.col("c") - F.col("part") * COPIES).alias("copies"))


def targets(base: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """A row per source: ``number`` from 0, ``source_size``, ``weight``, ``target`` and ``quota``, its
    target as a whole number.  Sources that reach their limit are those of the smallest limit per
    weight: one order of the sources settles them all."""
    own = base.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    own = own.withColumn("number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    own = own.withColumn("weight", F.get(turn, F.pmod("number", F.lit(len(weights))))).withColumn(
        "limit", F.col("source_size") * F.lit(float(repeats)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = (own.withColumn("all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
           .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
           .withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))))
    own = own.withColumn("full", F.col("limit") * F.col("left") < F.col("weight") * (F.col("all") - F.col("spent")))
    every = Window.partitionBy()
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(every), F.lit(0.0))
    left = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    target = F.least(F.col("limit"), F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * (F.col("all") - spent) / left))
    return own.withColumn("target", target).select(
        "source", "number", "source_size", "weight", "target", F.floor(F.col("target") + 0.5).cast("long").alias("quota"))


def _with_source(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Join by source, null equal to null: the sources' table is broadcast where its counted rows
    and bytes allow it, else joined by a salted key, as one source may hold most rows."""
    n, size = by_source.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0))).first()
    if n <= BROADCAST_SOURCES and size <= BROADCAST_BYTES:
        to = F.broadcast(by_source.withColumnRenamed("source", "s"))
        return rows.join(to, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    salts = by_source.withColumnRenamed("source", "s").withColumn("salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return salted.join(salts, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt") == F.col("salt2"))).drop("s", "salt", "salt2")


def _bits(n: int) -> int:
    """Smallest m with 2^m >= n."""
    return max(0, (max(n, 1) - 1).bit_length())


def mirrored(c: Column, bits: int) -> Column:
    """The ``bits`` lowest bits of a whole number in reverse: van der Corput's point times 2^bits."""
    if not bits:
        return F.lit(0).cast("long")
    return F.conv(F.reverse(F.lpad(F.bin(c), bits, "0")), 2, 10).cast("long")


def slots(by_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(slot, number, block)``: the schedule.  ``slot`` is the place in the mix (rising; places of
    points beyond the last block are left out), ``block`` the rank of the slot in its source."""
    order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    own = by_source.where("quota > 0").withColumn("n", F.ceil(F.col("quota") / block).cast("long"))
    own = own.withColumn("first", F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long"))
    total = own.agg(F.sum("n")).first()[0] or 0
    bits = _bits(total)
    tasks = total // (64 * STRETCH) + int(by_source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = F.lit(0).cast("long")
    points = (own.select("number", "first", "n", F.explode(F.sequence(long, F.floor((F.col("n") - 1) / STRETCH))).alias("part"))
              .repartition(tasks, "number", "part")
              .select("number", "first", F.explode(F.sequence(F.col("part") * STRETCH, F.least("n", (F.col("part") + 1) * STRETCH) - 1)).alias("i"))
              .select("number", mirrored(F.col("first") + F.col("i"), bits).alias("slot"))
              .withColumn("stretch", F.floor(F.col("slot") / STRETCH)))
    held = points.groupBy("number", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("number", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("number", "stretch").orderBy("slot")
    return (points.join(held, ["number", "stretch"])
            .select("slot", "number", (F.col("before") + F.row_number().over(inside) - 1).cast("long").alias("block")))


def shuffled(base: DataFrame, by_source: DataFrame, seed: int = 0) -> DataFrame:
    """Rows of ``base`` for every repeat of their source that its quota reaches, with the position
    ``at`` of their first token in the source's repeated stream."""
    rows = _with_source(base.where("size > 0"), by_source.select("source", "number", "source_size", "quota"))
    n = base.count()
    bits = _bits(n // RANGE + 1)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("repeat").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")),
                            F.col("size").cast("string"), F.col("part").cast("string")))
    last = F.floor((F.col("quota") - 1) / F.col("source_size"))
    rows = rows.where("quota > 0").withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("key", key)
    rows = rows.withColumn("range", F.shiftright(F.conv(F.substring("key", 1, 12), 16, 10).cast("long"), 48 - bits))
    tokens = F.col("size") * F.col("copies")
    held = rows.groupBy("number", "repeat", "range").agg(F.sum(tokens).alias("n"))
    earlier = Window.partitionBy("number", "repeat").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("number", "repeat", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = (Window.partitionBy("number", "repeat", "range").orderBy("key", F.col("id").asc_nulls_first(), "size", "part")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inner", F.coalesce(F.sum(tokens).over(inside), F.lit(0)))
    return rows.join(held, ["number", "repeat", "range"]).withColumn(
        "at", F.col("repeat") * F.col("source_size") + F.col("before") + F.col("inner")).where("at < quota").drop("before", "inner", "range", "key")


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(number, block, id, source, size, copy, repeat, first, tokens)``: the stretch of each document
    in each block of its source's stream."""
    copy = rows.withColumn("own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    at = F.col("at") + F.col("own") * F.col("size")
    copy = (copy.select("number", "id", "source", "size", "repeat", "quota", (F.col("part") * COPIES + F.col("own")).alias("copy"), at.alias("at"))
            .withColumn("end", F.least(F.col("at") + F.col("size"), F.col("quota"))).where("end > at"))
    cut = copy.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block))))
    lo = F.greatest("at", F.col("block") * block)
    hi = F.least("end", (F.col("block") + 1) * block)
    return cut.select("number", "block", "id", "source", "size", "copy", "repeat", (lo - F.col("at")).alias("first"), (hi - lo).alias("tokens"))


def mix(base: DataFrame, by_source: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """The mix: per slot the pieces of documents in its block, ``(slot, number, block, id, source, size,
    copy, repeat, first, tokens)``; in a slot they follow each other by source stream."""
    return slots(by_source, block).join(pieces(shuffled(base, by_source, seed), block), ["number", "block"])


def texts(docs: DataFrame, mixed: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``mixed`` with ``words``, the tokens of each piece.  Copies share a text only if ids are
    unique; where they are not, a piece is given the text of one row of its id, source and size."""
    found = docs.select(F.col(id).alias("i"), F.col(source).cast("string").alias("s"),
                        F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias("w")).where(F.size("w") > 0)
    found = found.groupBy("i", "s", F.size("w").cast("long").alias("z")).agg(F.min("w").alias("w"))
    return (mixed.join(found, F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
            .withColumn("words", F.slice("w", (F.col("first") + 1).cast("int"), F.col("tokens").cast("int"))).drop("i", "s", "z", "w"))


def taken(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """A row per document: id, ``size``, ``source``, ``source_size``, ``target`` of its source and ``taken``,
    the tokens that the mix holds of it, repeats counted, summed over the mix."""
    base = written(sizes(docs, id, text, source), "sizes")
    by_source = written(targets(base), "targets")
    used = mix(base, by_source, block).select("id", "source", "size", "copy", "tokens")
    every = base.withColumn("own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select(
        "id", "source", "size", (F.col("part") * COPIES + F.col("own")).alias("copy"), F.lit(0).cast("long").alias("tokens"))
    per = every.unionByName(used).groupBy("id", "source", "size", "copy").agg(F.sum("tokens").alias("taken"))
    return _with_source(per, by_source.select("source", "source_size", "target")).select(
        F.col("id").alias(id), "size", "source", "source_size", "target", "taken")


#: The same rows by SQL, where ids are unique (so every row is its own copy 0).
ORACLE_SQL = f"""
WITH b AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number FROM b GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[number % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS lim, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
f AS (SELECT *, lim * sum(weight) OVER (ORDER BY lim / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
          < weight * (total - coalesce(sum(lim) OVER (ORDER BY lim / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS isfull FROM w),
t AS (SELECT *, least(lim, CASE WHEN isfull THEN lim ELSE weight * (total - coalesce(sum(CASE WHEN isfull THEN lim END) OVER (), 0))
          / sum(CASE WHEN NOT isfull THEN weight END) OVER () END) AS target FROM f),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM t),
o AS (SELECT b.doc_id, b.size, q.source, q.source_size, q.quota, r AS repeat,
             r * q.source_size + coalesce(sum(b.size) OVER (PARTITION BY q.number, r ORDER BY md5('0|' || r || '|' || coalesce(CAST(b.doc_id AS VARCHAR), '')
               || '|' || b.size || '|0') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source, range(2) g(r) WHERE b.size > 0),
u AS (SELECT doc_id, CAST(sum(greatest(0, least(start + size, quota) - start)) AS BIGINT) AS taken FROM o GROUP BY doc_id)
SELECT b.doc_id, b.size, q.source_size, q.target, coalesce(u.taken, 0) AS taken
FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source LEFT JOIN u ON u.doc_id IS NOT DISTINCT FROM b.doc_id"""
