"""Scaler fitting and application per series.

Reference semantics (not Spark ML's): min-max with divisor 1 for a constant
feature (-> 0), standard scaling with the POPULATION std. Params are a long
table (key, feature, kind, shift, scale) that can be persisted and re-read.
Fitting is ONE wide aggregation per key (partial aggregation map-side), then
a narrow stack — never an unpivot of the whole feature table before a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scaling as sc


def fit_minmax(df: DataFrame, features: Sequence[str], key: str = "Store",
               scope: Column | None = None) -> DataFrame:
    """Per key and feature: min and max (``scope`` = rows used for fitting;
    None = all rows, the reference's choice; pass the train rows to avoid leakage)."""
    def v(c):
        x = F.col(c).cast("double")
        return x if scope is None else F.when(scope, x)
    aggs = [a for i, c in enumerate(features) for a in (F.min(v(c)).alias(f"_lo{i}"), F.max(v(c)).alias(f"_hi{i}"))]
    wide = df.groupBy(key).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_lo{i}").alias("min"), F.col(f"_hi{i}").alias("max"))
                    for i, c in enumerate(features)])
    return wide.select(key, F.inline(arr))


def fit_standard(df: DataFrame, col: str, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def params_long(minmax: DataFrame, key: str = "Store") -> DataFrame:
    """(key, feature, kind, shift, scale): x_scaled = (x - shift) / scale."""
    return minmax.select(key, "feature", F.lit("minmax").alias("kind"), F.col("min").alias("shift"),
                         sc.safe_range(F.col("min"), F.col("max")).alias("scale"))


def apply_minmax(df: DataFrame, params: DataFrame, features: Sequence[str], key: str = "Store",
                 suffix: str = "_scaled", clip: bool = False) -> DataFrame:
    """Scale ``features`` with fitted params. The params are pivoted to one
    row per key (a known column list, no distinct-values job) and joined on
    the key; AQE turns the join into a broadcast from the runtime size of
    the params (one row per key), else it stays a sort-merge join."""
    wide = params.groupBy(key).pivot("feature", list(features)).agg(F.first("min").alias("lo"),
                                                                     F.first("max").alias("hi"))
    j = df.join(wide, key, "left")
    out = []
    for c in features:
        z = sc.minmax_transform(F.col(c).cast("double"), F.col(f"{c}_lo"), F.col(f"{c}_hi"))
        if clip:
            z = F.least(F.greatest(z, F.lit(0.0)), F.lit(1.0))
        out.append(z.alias(c + suffix))
    keep = [c for c in df.columns]
    return j.select(*keep, *out)


def minmax_over_partition(df: DataFrame, features: Sequence[str], key: str = "Store",
                          suffix: str = "_scaled", scope: Column | None = None) -> DataFrame:
    """Fit+transform in one pass with window aggregates over the key partition
    (reuses the partitioning of the feature windows: no join, no shuffle)."""
    w = Window.partitionBy(key)
    cols = []
    for c in features:
        x = F.col(c).cast("double")
        fit = x if scope is None else F.when(scope, x)
        cols.append(sc.minmax_transform(x, F.min(fit).over(w), F.max(fit).over(w)).alias(c + suffix))
    return df.select("*", *cols)
