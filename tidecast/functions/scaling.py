"""Scaler arithmetic on columns (constant feature -> divisor 1; population std)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_range(lo: Column, hi: Column) -> Column:
    r = hi - lo
    return F.when(r == 0, F.lit(1.0)).otherwise(r)


def minmax_transform(x: Column, lo: Column, hi: Column) -> Column:
    return (x - lo) / safe_range(lo, hi)


def minmax_inverse(z: Column, lo: Column, hi: Column) -> Column:
    return z * safe_range(lo, hi) + lo


def standard_transform(x: Column, mean: Column, std: Column) -> Column:
    return (x - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def standard_inverse(z: Column, mean: Column, std: Column) -> Column:
    return z * F.when(std == 0, F.lit(1.0)).otherwise(std) + mean
