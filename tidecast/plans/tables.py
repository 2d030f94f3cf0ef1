"""The offline pipeline as one lazily planned DAG:
daily fact -> processed table -> feature table -> windows -> evaluation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean, features, joins
from ..session import shared_dir
from ..sources import panel


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fact LEFT JOIN store dimension (before any cleaning)."""
    return joins.join_sales_store(panel.sales_daily(spark, sf_dir), panel.store_dim(spark, sf_dir))


def processed(spark: SparkSession, sf_dir: str, stores: Iterable[int] | None = None,
              grain: str = "nation") -> DataFrame:
    """The processed table: open days, no leakage column, imputed, one-hot,
    calendar parts. Filters are written first so Catalyst pushes them into
    the scans; the store dimension is read once."""
    dim = panel.store_dim(spark, sf_dir, grain)
    df = joins.join_sales_store(panel.sales_daily(spark, sf_dir, grain), dim)
    df = open_days(df, stores)
    df = clean.impute_median(df, dim)
    df = clean.impute_zero(df)
    df = clean.one_hot(df)
    return clean.add_calendar(df)


def open_days(daily: DataFrame, stores: Iterable[int] | None = None) -> DataFrame:
    """Filters and column selection that every table of open days starts with."""
    df = clean.filter_open_days(clean.filter_store(daily, stores))
    return clean.select_present(clean.drop_leakage_columns(df))


def feature_table(spark: SparkSession, sf_dir: str, stores: Iterable[int] | None = None,
                  grain: str = "nation") -> DataFrame:
    """Features of the daily fact alone: no feature reads the store dimension, so
    it is not joined."""
    df = open_days(panel.sales_daily(spark, sf_dir, grain), stores)
    return features.engineer_features(clean.add_calendar(df))


def synthetic_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.synthetic_features(panel.product_daily(spark, sf_dir))


def reused(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table read by several branches of one query: reliably checkpointed
    to the shared ``spark.checkpoint.dir`` (computed once, lineage cut, the
    store partitioning and ordering are kept for the branches)."""
    shared_dir(spark)
    return df.checkpoint(eager=True)
