"""Projections, filters and cleaning (open days, leakage, imputation, one-hot)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..params import CATEGORIES, KEEP_COLUMNS, ZERO_FILL_COLUMNS
from . import selection


def filter_store(df: DataFrame, stores: Iterable[int] | None = None) -> DataFrame:
    """Keep a set of stores; None keeps all (the panel default)."""
    return df if stores is None else df.filter(F.col("Store").isin(list(stores)))


def filter_open_days(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Open") == 1)


def open_day_report(df: DataFrame) -> DataFrame:
    """Rows before / removed / after the open-day filter, per store."""
    return df.groupBy("Store").agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.sum((F.col("Open") != 1).cast("bigint")).alias("rows_removed"),
        F.sum((F.col("Open") == 1).cast("bigint")).alias("rows_after"))


def drop_leakage_columns(df: DataFrame, cols: Iterable[str] = ("Customers",)) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def select_present(df: DataFrame, wanted: Iterable[str] = KEEP_COLUMNS) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])


def prune_missing_features(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """(kept, dropped) — features absent from the table are dropped."""
    kept = [c for c in features if c in df.columns]
    return kept, [c for c in features if c not in df.columns]


def impute_median(df: DataFrame, store_dim: DataFrame, col: str = "CompetitionDistance") -> DataFrame:
    """Fill ``col`` with the exact (interpolated) median over the store dimension."""
    if col not in df.columns:
        return df
    med = selection.median(store_dim, col)
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(med).cast("double")))


def impute_zero(df: DataFrame, cols: Iterable[str] = ZERO_FILL_COLUMNS) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.fillna(0, subset=present) if present else df


def one_hot(df: DataFrame, categories: dict[str, list[str]] = CATEGORIES) -> DataFrame:
    """Indicator ints ``col_value`` for an explicit category list (stable
    schema); NULL -> 0 in every indicator; the original column is dropped.
    One projection for all categorical columns."""
    present = {c: v for c, v in categories.items() if c in df.columns}
    keep = [c for c in df.columns if c not in present]
    dummies = [F.coalesce(F.col(c) == v, F.lit(False)).cast("int").alias(f"{c}_{v}")
               for c, values in present.items() for v in values]
    return df.select(*keep, *dummies)


def add_calendar(df: DataFrame, date_col: str = "Date", dow_col: str = "DayOfWeek") -> DataFrame:
    d = F.col(date_col)
    parts = cal.calendar_parts(d)
    return df.select("*", *[c.alias(n) for n, c in parts.items()],
                     cal.is_weekend(F.col(dow_col)).alias("IsWeekend"))


def drop_incomplete_features(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def promo_flag_alias(df: DataFrame) -> DataFrame:
    return df.withColumn("is_promo_day", F.col("Promo").cast("int")) if "Promo" in df.columns else df
