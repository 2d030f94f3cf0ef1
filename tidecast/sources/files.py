"""File sources and sinks with explicit schemas.

Every write goes to a NEW path under the shared checkpoint folder (never an
overwrite of a path being read); reading back cuts the lineage, so a lost
executor recomputes from the written files, not from the raw scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **opts) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass)."""
    r = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    for k, v in opts.items():
        r = r.option(k, v)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, **opts) -> str:
    w = df.write.mode("errorifexists").option("header", True)
    for k, v in opts.items():
        w = w.option(k, v)
    w.csv(path)
    return path


def csv_round_trip(spark: SparkSession, df: DataFrame, name: str, **opts) -> DataFrame:
    """Write ``df`` as CSV to the shared folder and read it back with its schema."""
    path = write_csv(df, scratch_path(spark, name), **opts)
    return read_csv(spark, path, df.schema, **opts)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to a new parquet table in the shared folder and read it back."""
    path = write_table(df, scratch_path(spark, name), partition_by)
    return spark.read.parquet(path)


def contract_check(df: DataFrame, table: str, expected: T.StructType) -> DataFrame:
    """One row per expected column: present, actual type, type ok and the
    non-null count (one aggregation pass over the data, then a narrow stack)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f.name)).alias(f"_nn{i}") for i, f in enumerate(expected.fields)
                      if f.name in actual])
    rows = []
    for i, f in enumerate(expected.fields):
        have = f.name in actual
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
            F.lit(have).alias("present"),
            F.lit(actual.get(f.name) == f.dataType.simpleString()).alias("type_ok"),
            (F.col(f"_nn{i}") if have else F.lit(0).cast("bigint")).alias("non_null"),
            F.col("_rows").alias("rows")))
    return counts.select(F.inline(F.array(*rows)))


class ContractError(ValueError):
    """An input table lacks required columns or has the wrong types."""


def require_contract(df: DataFrame, table: str, expected: T.StructType) -> DataFrame:
    """Fail fast (schema only, no job) when required columns are missing or
    mistyped; returns ``df`` unchanged otherwise."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in actual]
    wrong = [f"{f.name}: {actual[f.name]} != {f.dataType.simpleString()}" for f in expected.fields
             if f.name in actual and actual[f.name] != f.dataType.simpleString()]
    if missing or wrong:
        raise ContractError(f"{table}: missing {missing}, wrong types {wrong}; has {sorted(actual)}")
    return df
