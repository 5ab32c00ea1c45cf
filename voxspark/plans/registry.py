"""Query registry: each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` plus,
where SQL can express it, the equivalent DuckDB SQL over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, covers or (name.split("_")[0].upper(),))
        return fn
    return deco


def r6(c) -> Column:
    """Round a double to 6 places for cross-engine comparison (both sides)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
