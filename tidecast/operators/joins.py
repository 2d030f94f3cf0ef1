"""Joins of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_sales_store(sales: DataFrame, store_dim: DataFrame) -> DataFrame:
    """LEFT equi join of the daily fact with the store dimension.

    No hint: the dimension (one row per store) is broadcast by Catalyst while
    its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, or by
    AQE from runtime statistics; beyond that bound Spark plans a sort-merge
    join. The size check is Spark's, so it holds at any store count."""
    return sales.join(store_dim, "Store", "left")
