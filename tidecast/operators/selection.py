"""Exact order statistics of a column by distributed selection.

A quantile needs the value at one rank. Spark's exact ``median`` keeps every distinct value in one
task; here a table of more than ``BOUND`` distinct values is narrowed instead: a mergeable sketch
proposes ``RANGES`` edges of about equal counts, one aggregation counts exactly what lies below and at each edge, and
the one range that holds the rank is narrowed again, until it has at most ``BOUND`` distinct values. Only
those, with their counts, reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOUND = 65_536
RANGES = 64


def _pairs(values: DataFrame, bound: int) -> list | None:
    """(value, count) of all distinct values in order, None if there are more than ``bound``."""
    rows = values.groupBy("v").count().limit(bound + 1).collect()
    return sorted((r.v, r["count"]) for r in rows) if len(rows) <= bound else None


def _at(pairs: list, rank: int) -> float:
    for v, n in pairs:
        if rank < n:
            return v
        rank -= n
    raise ValueError("rank beyond the values")


def value_at(values: DataFrame, rank: int, bound: int = BOUND, ranges: int = RANGES) -> float:
    """The value at a rank (from 0) of the non-null doubles in column ``v``."""
    while True:
        pairs = _pairs(values, bound)
        if pairs is not None:
            return _at(pairs, rank)
        shares = [k / ranges for k in range(ranges + 1)]
        edges = sorted(set(values.select(F.percentile_approx("v", shares, 100 * ranges)).first()[0]))
        sides = [F.count_if(F.col("v") < F.lit(e)) for e in edges] + [F.count_if(F.col("v") <= F.lit(e)) for e in edges]
        counts = list(values.agg(*[c.alias(f"c{k}") for k, c in enumerate(sides)]).first())
        below, upto = counts[:len(edges)], counts[len(edges):]
        for k, e in enumerate(edges):
            if below[k] <= rank < upto[k]:
                return e
        at = max((k for k in range(len(edges)) if upto[k] <= rank), default=None)
        if at is not None:
            values, rank = values.filter(F.col("v") > F.lit(edges[at])), rank - upto[at]
        over = next((e for k, e in enumerate(edges) if below[k] > (rank + (upto[at] if at is not None else 0))), None)
        if over is not None:
            values = values.filter(F.col("v") < F.lit(over))


def median(df: DataFrame, column: str, bound: int = BOUND, ranges: int = RANGES) -> float | None:
    """The median of the non-null values (mean of the two middle ones), None without any; NaN counts as null."""
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    pairs = _pairs(values, bound)
    n = sum(c for _, c in pairs) if pairs is not None else values.count()
    if not n:
        return None
    ranks = sorted({(n - 1) // 2, n // 2})
    found = [_at(pairs, r) if pairs is not None else value_at(values, r, bound, ranges) for r in ranks]
    return sum(found) / len(found)
