"""Packing into fixed-size windows by Karmarkar-Karp multiway differencing.

Every document becomes token ids and an end id.  Its full windows stand alone; its tail
joins the other tails of the same task, ``batch`` at a time (bounded memory, no shuffle).
The tails start as partial partitions of k windows; the two partitions with the largest
imbalance are merged again and again, the heaviest window of one with the lightest of the
other, until one partition is left: near-equal windows.  k starts at the total length
over the capacity and rises whenever a window exceeds the capacity.

Defined results: null text counts as empty (the end id alone); every id lies in exactly one
piece; repeated rows are separate documents; an empty table gives no pieces.  Window
numbers hold the partition in their upper bits, so a retried task numbers them the same.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import coder

CAPACITY, END_ID, BATCH = 4096, 2, 1024


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: indexes of ``sizes`` dealt to k windows of near-equal sums.  A partial
    partition holds its non-empty windows, heaviest first; items are kept as nested pairs
    and flattened at the end.  Ties: the earlier made partition first."""
    if not sizes:
        return []
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = k - len(a)               # windows that are empty in a take b's heaviest
        new = a + b[:free]
        for j, (s, items) in enumerate(b[free:]):
            at = len(a) - 1 - j         # then a's lightest take b's next
            new[at] = (new[at][0] + s, (new[at][1], items))
        new.sort(key=lambda w: -w[0])
        low = new[-1][0] if len(new) == k else 0
        heapq.heappush(heap, (low - new[0][0], n, new))
        n += 1
    out = []
    for _, tree in heap[0][2]:
        flat, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                flat.append(x)
        out.append(sorted(flat))
    return out


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Differencing with the smallest k, from total over capacity up, that fits the capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        out = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in out):
            return out
        k += 1


def ids_of(text: str, path: str, end_id: int = END_ID) -> bytes:
    """Token ids of a whole text and the end id, as little-endian unsigned 32-bit numbers."""
    c = coder(path, True)
    chunks = c.chunks(text)
    if chunks is None:
        body = array("I", c.whole(text)).tobytes()
    else:
        body = b"".join(c.looked_up(chunks, lambda x: array("I", c.word_ids(x)).tobytes()))
    return body + array("I", [end_id]).tobytes()


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, batch: int = BATCH) -> DataFrame:
    """One row per piece: id, start, doc_tokens, sequence_id, offset and ids (``binary``: little-endian unsigned
    32-bit numbers); the ids in order of ``(sequence_id, offset)`` are the packed sequences."""
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, doc_tokens long, sequence_id long, offset long, ids binary"
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 36, 0
        rows: list[tuple] = []          # finished pieces
        tails: list[tuple] = []         # (id, start, ids, doc_tokens)

        def piece(key, start, ids, total, seq, offset):
            rows.append((key, start, total, base + seq, offset, ids))

        def close() -> None:
            nonlocal made
            for w in windows([len(t[2]) // 4 for t in tails], capacity) if tails else []:
                at = 0
                for i in w:
                    key, start, ids, total = tails[i]
                    piece(key, start, ids, total, made, at)
                    at += len(ids) // 4
                made += 1
            tails.clear()

        def out() -> pa.RecordBatch:
            *cols, ids = zip(*rows)
            got = pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(cols, [id_type, *[pa.int64()] * 4])],
                                              pa.array(ids, pa.binary())],
                                             ["id", "start", "doc_tokens", "sequence_id", "offset", "ids"])
            rows.clear()
            return got

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = ids_of(text.as_py(), path, end_id)
                total, full = len(ids) // 4, len(ids) // (4 * capacity)
                for j in range(full):
                    piece(key, j * capacity, ids[4 * j * capacity:4 * (j + 1) * capacity], total, made, 0)
                    made += 1
                if total > full * capacity:
                    tails.append((key, full * capacity, ids[4 * full * capacity:], total))
                if len(tails) >= batch:
                    close()
                if len(rows) >= 4096:
                    yield out()
        close()
        if rows:
            yield out()

    out = src.mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, batch: int = BATCH, with_ids: bool = True) -> DataFrame:
    """The pieces with the length and digest of their ids column: id, start, length, ids_crc32 (of its
    bytes), doc_tokens, sequence_id, offset and, if asked, ids."""
    made = pieces(df, path, id_col, text_col, capacity, end_id, batch)
    return made.select(id_col, "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                       "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
