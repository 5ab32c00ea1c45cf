"""Token counts with the whole-token shortcut.

Beforehand, every vocabulary string that is valid text is encoded alone; those that come
back as one token are proven whole.  A text's count is then: one for each of its
pre-tokens that is a proven string, and the merged length of the others; counts of the
white-space chunks are kept in a bounded memo, so each is worked out once per worker.  Whole texts, no truncation.

Defined results: null text counts as empty, 0 bytes and 0 tokens; one output row per input
row, repeated rows included; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import PRE_TOKEN, byte_characters, coder

_whole: dict = {}


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as exactly one token."""
    if path not in _whole:
        c, byte = coder(path, False), {x: b for b, x in byte_characters().items()}
        found = []
        for s in c.library.get_vocab(with_added_tokens=False):
            try:
                found.append(bytes(byte[x] for x in s).decode())
            except (KeyError, UnicodeDecodeError):      # part of a character
                pass
        alone = c.library.encode_batch(found, add_special_tokens=False)
        _whole[path] = frozenset(s for s, e in zip(found, alone) if len(e.ids) == 1)
    return _whole[path]


def _count(chunk: str, path: str) -> int:
    """Tokens of a chunk: its proven pre-tokens count one, the rest are merged."""
    c, whole = coder(path, False), whole_tokens(path)
    if chunk in whole:
        return 1
    return sum(1 if p in whole else len(c.merged(p)) for p in PRE_TOKEN.findall(chunk))


def count_one(text: str, path: str) -> int:
    c = coder(path, False)
    chunks = c.chunks(text)
    if chunks is None:
        return len(c.whole(text))
    return sum(c.looked_up(chunks, lambda x: _count(x, path)))


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row of ``df``."""
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [count_one(t.as_py(), path) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())],
                                             ["id", "n_bytes", "n_tokens"])

    src = src.withColumn("n_bytes", F.octet_length("text").cast("long"))
    out = src.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
