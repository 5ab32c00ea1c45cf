"""Global row index and running sums without a single-partition window.

``row_number()`` over an unpartitioned window moves every row into one task.  Instead the
*order columns alone* are range-partitioned, sorted inside each partition and written to the
shared scratch folder; one row count per partition (at most ``n_parts`` numbers reach the
driver) gives offsets, a broadcast bounded by the partition count.  The numbers go back to the
rows by one null-safe equi join on the order columns.  No row's other columns are sorted,
range-shuffled or cached, and a caller that needs only some columns reads only those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written


def _cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranged(df: DataFrame, order: list[str], n_parts: int | None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their partition and place in it.  The
    written files fix both: range bounds come from a sample that another run could draw anew."""
    # without an explicit count AQE may merge adjacent ranges: still in order
    by_range = df.repartitionByRange(n_parts, *order) if n_parts else df.repartitionByRange(*order)
    return by_range.sortWithinPartitions(*order)


def _offsets(spark, rows: list, names: list[str], types: list[str]) -> DataFrame:
    """Sums of all earlier partitions, from one row of sums per partition."""
    run, out = [0] * len(names), []
    for r in sorted(rows, key=lambda r: r["_pid"]):
        out.append((r["_pid"], *[(float(x) if t == "double" else x) for x, t in zip(run, types)]))
        run = [x + (r[n] or 0) for x, n in zip(run, names)]
    ddl = ", ".join(["_pid int"] + [f"_off_{n} {t}" for n, t in zip(names, types)])
    return spark.createDataFrame(out, ddl)


def indexed(df: DataFrame, order, col: str = "idx", n_parts: int | None = None, group: int = 0,
            pos: str = "pos") -> tuple[DataFrame, int]:
    """``df`` with a 0-based global index in ``order``, and the number of rows.  With ``group`` the first
    so many order columns form groups, and ``pos`` is the position inside the row's group.

    ``order`` should be total (end it with a unique key): then the index is the same in every run.
    Rows equal in all order columns get consecutive numbers in an arbitrary order.  Null order
    columns sort first and are values like others."""
    order = _cols(order)
    names = [f"_k{i}" for i in range(len(order))]
    keys = df.select(*[c.alias(k) for c, k in zip(order, names)])
    # grouping by the range columns needs no further shuffle: equal keys lie in one range
    table = written(_ranged(keys, names, n_parts).groupBy(*names).agg(F.count("*").alias("_n")).sortWithinPartitions(*names)
                    .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "index")
    sums = table.groupBy("_pid").agg(F.sum("_n").alias("_n"), F.max("_n").alias("_most")).collect()
    total, ties = sum(r["_n"] for r in sums), any(r["_most"] > 1 for r in sums)
    if ties:
        inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_pid").orderBy("_at")
                                             .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        inside = F.col("_at") - F.shiftleft(F.col("_pid").cast("long"), 33)
    first = table.withColumn("_in", inside).join(F.broadcast(_offsets(df.sparkSession, sums, ["_n"], ["long"])), "_pid")
    first = first.select(*names, (F.col("_off__n") + F.col("_in")).alias("_first"))
    if group:
        held = names[:group]
        starts = first.groupBy(*[F.col(k).alias(f"_s{k}") for k in held]).agg(F.min("_first").alias("_start"))
        same = [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in held]
        first = first.join(starts, same).drop(*[f"_s{k}" for k in held])
    out = df.withColumns({f"_o{k}": c for c, k in zip(order, names)}).join(
        first, [F.col(f"_o{k}").eqNullSafe(F.col(k)) for k in names])
    if ties:
        out = out.withColumn("_first", F.col("_first") + F.row_number().over(Window.partitionBy(*names).orderBy(*names)) - 1)
    out = out.withColumn(col, F.col("_first").cast("long"))
    if group:
        out = out.withColumn(pos, F.col("_first") - F.col("_start"))
    return out.drop(*names, *[f"_o{k}" for k in names], "_first", "_start"), total


def with_index(df: DataFrame, order, col: str = "idx", n_parts: int | None = None, group: int = 0,
               pos: str = "pos") -> DataFrame:
    """``indexed`` without the count."""
    return indexed(df, order, col, n_parts, group, pos)[0]


def running_sums(df: DataFrame, order, values: dict[str, str],
                 n_parts: int | None = None) -> DataFrame:
    """Inclusive running sums (``out <- value``) in a total ``order`` with the same
    partition-offset scheme: a window per range partition (bounded by the partition
    size, never by a key) plus broadcast per-partition offsets.  For narrow tables such as
    histograms: their rows are written to the scratch folder whole."""
    ranged = written(_ranged(df, list(order), n_parts).withColumn("_pid", F.spark_partition_id()), "sums")
    sums = ranged.groupBy("_pid").agg(*[F.sum(v).alias(o) for o, v in values.items()]).collect()
    types = dict(df.dtypes)
    kinds = ["long" if types[v] in ("int", "bigint", "smallint", "tinyint") else "double" for v in values.values()]
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({f"_loc_{o}": F.sum(v).over(w) for o, v in values.items()})
    out = out.join(F.broadcast(_offsets(df.sparkSession, sums, list(values), kinds)), "_pid")
    for o in values:
        out = out.withColumn(o, F.col(f"_off_{o}") + F.col(f"_loc_{o}"))
    return out.drop("_pid", *[f"_off_{o}" for o in values], *[f"_loc_{o}" for o in values])
