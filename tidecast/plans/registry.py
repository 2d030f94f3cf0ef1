"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str = ""


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def r4(c: Column | str) -> Column:
    """Doubles leave a query rounded to 4 decimals (same in the oracle SQL)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 4)
