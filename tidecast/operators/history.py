"""Forecast history: a parquet table of forecast log rows.

Payloads are JSON text columns (``to_json`` / ``from_json``) beside four
extracted summary columns. Appends add files under a ``created_date``
partition (an append-only log grows by day, not by store: the number of
directories per append stays 1-2 however many stores there are, and
"recent" reads prune old days). A delete rewrites only the days that hold a
deleted id, to a new folder; the files of the other days are read on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .decisions import insights_struct

DAY = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("day_of_week", T.IntegerType()),
    T.StructField("weekday", T.StringType()), T.StructField("is_weekend", T.IntegerType()),
    T.StructField("promo", T.IntegerType()), T.StructField("school_holiday", T.IntegerType()),
    T.StructField("predicted_sales", T.LongType()), T.StructField("demand_level", T.StringType()),
])
INSIGHTS = T.StructType([
    T.StructField("total_predicted_sales", T.LongType()), T.StructField("average_predicted_sales", T.LongType()),
    T.StructField("expected_revenue", T.DoubleType()), T.StructField("current_stock", T.LongType()),
    T.StructField("projected_stock_after_7_days", T.LongType()), T.StructField("stockout_risk", T.StringType()),
    T.StructField("recommended_reorder_quantity", T.LongType()), T.StructField("reorder_needed", T.BooleanType()),
    T.StructField("recommendation", T.StringType()),
])
RESPONSE = T.StructType([
    T.StructField("store_id", T.IntegerType()), T.StructField("model_name", T.StringType()),
    T.StructField("model_version", T.StringType()), T.StructField("forecast_mode", T.StringType()),
    T.StructField("latest_historical_date", T.StringType()), T.StructField("forecast_days", T.IntegerType()),
    T.StructField("total_predicted_sales", T.LongType()), T.StructField("average_predicted_sales", T.LongType()),
    T.StructField("highest_demand_day", T.StringType()), T.StructField("lowest_demand_day", T.StringType()),
    T.StructField("forecast", T.ArrayType(DAY)), T.StructField("business_insights", INSIGHTS),
])
REQUEST = T.StructType([
    T.StructField("forecast_days", T.IntegerType()), T.StructField("forecast_open_days_only", T.BooleanType()),
    T.StructField("promo_dates", T.ArrayType(T.StringType())),
    T.StructField("school_holiday_dates", T.ArrayType(T.StringType())),
    T.StructField("current_stock", T.LongType()), T.StructField("unit_price", T.DoubleType()),
    T.StructField("reorder_lead_time_days", T.IntegerType()), T.StructField("safety_stock_percentage", T.DoubleType()),
])


def _dates_text(c: str):
    return F.transform(F.col(c), lambda d: F.date_format(d, "yyyy-MM-dd"))


def day_records() -> Column:
    """The forecast days of a row as records of the response."""
    return F.transform(F.col("days"), lambda d: F.struct(
        F.date_format(d["date"], "yyyy-MM-dd").alias("date"), d["day_of_week"].alias("day_of_week"),
        d["weekday"].alias("weekday"), d["is_weekend"].alias("is_weekend"), d["promo"].alias("promo"),
        d["school_holiday"].alias("school_holiday"), d["predicted_sales"].alias("predicted_sales"),
        d["demand_level"].alias("demand_level")))


def log_rows(fc: DataFrame, id_col: str = "request_id", created_at: str = "created_at") -> DataFrame:
    """Forecast + insights rows -> log rows (one per forecast)."""
    day = day_records()
    insights = insights_struct()
    response = F.struct(
        F.col("Store").alias("store_id"), "model_name", "model_version", "forecast_mode",
        F.date_format("latest_date", "yyyy-MM-dd").alias("latest_historical_date"), "forecast_days",
        F.col("total_predicted_sales").alias("total_predicted_sales"),
        F.col("response_average").alias("average_predicted_sales"),
        F.date_format("highest_demand_day", "yyyy-MM-dd").alias("highest_demand_day"),
        F.date_format("lowest_demand_day", "yyyy-MM-dd").alias("lowest_demand_day"),
        day.alias("forecast"), insights.alias("business_insights"))
    request = F.struct("forecast_days", "forecast_open_days_only", _dates_text("promo_dates").alias("promo_dates"),
                       _dates_text("school_holiday_dates").alias("school_holiday_dates"), "current_stock",
                       "unit_price", "reorder_lead_time_days", "safety_stock_percentage")
    return fc.select(
        F.col(id_col).cast("bigint").alias("id"), F.col("Store").cast("int").alias("store_id"),
        F.to_json(request).alias("request_payload"), F.to_json(response).alias("response_payload"),
        F.col("total_predicted_sales").cast("bigint").alias("total_predicted_sales"),
        F.col("average_predicted_sales").cast("bigint").alias("average_predicted_sales"),
        F.col("stockout_risk"), F.col("reorder_needed"),
        F.col(created_at).alias("created_at"), F.col(created_at).alias("updated_at"),
        F.to_date(F.col(created_at)).alias("created_date"))


def log_write(rows: DataFrame, path: str, mode: str) -> str:
    """Rows under their created_date partition; grouped by day first, so a day of
    an append is written by few tasks (its hot days by several, as AQE splits them)."""
    rows.hint("rebalance", "created_date").write.mode(mode).partitionBy("created_date").parquet(path)
    return path


def log_append(rows: DataFrame, path: str) -> str:
    """Append log rows (new files only) under their created_date partition."""
    return log_write(rows, path, "append")


def newest_days(log: DataFrame, limit: int) -> DataFrame:
    """The newest created_date partitions that together hold ``limit`` rows (or all):
    one count per day, a table of days."""
    days = log.groupBy("created_date").agg(F.count(F.lit(1)).alias("n"))
    newer = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("created_date"))
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return days.withColumn("newer", newer).filter(F.col("newer") < limit).select("created_date")


def log_recent(log: DataFrame, limit: int = 20) -> DataFrame:
    """7 summary columns, newest first (id breaks ties), first ``limit`` rows. Only
    the newest days that can hold them are read in full: their dates are found
    first and become a partition filter."""
    since = newest_days(log, limit).agg(F.min("created_date")).first()[0]
    rows = log if since is None else log.filter(F.col("created_date") >= F.lit(since))
    return rows.select("id", "store_id", "total_predicted_sales", "average_predicted_sales", "stockout_risk",
                       "reorder_needed", "created_at").orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def log_get(log: DataFrame, log_id: int) -> DataFrame:
    return log.filter(F.col("id") == log_id)


def log_delete(spark: SparkSession, path: str, ids: Sequence[int] | DataFrame, name: str = "forecast_log") -> DataFrame:
    """Remove ids; returns the log without them. Only days that hold one of the ids
    are rewritten, to a new folder; the files of all other days stay as they are
    and are read beside it (no file is overwritten or deleted)."""
    log = spark.read.parquet(path)
    id_df = ids if isinstance(ids, DataFrame) else spark.createDataFrame([(int(i),) for i in ids], "id bigint")
    days = [r[0] for r in log.join(id_df, "id", "left_semi").select("created_date").distinct().collect()]
    touched = F.col("created_date").isin(days) if days else F.lit(False)
    new = log_write(log.filter(touched).join(id_df, "id", "left_anti"), scratch_path(spark, name), "errorifexists")
    rewritten = spark.read.schema(log.schema).parquet(new)
    return log.filter(~touched | F.col("created_date").isNull()).unionByName(rewritten)


def parse_response(log: DataFrame) -> DataFrame:
    return log.withColumn("response", F.from_json("response_payload", RESPONSE)) \
              .withColumn("request", F.from_json("request_payload", REQUEST))


def log_explode(log: DataFrame) -> DataFrame:
    """Stored forecasts re-opened as day rows."""
    p = parse_response(log)
    return p.select("id", "store_id", F.inline("response.forecast"))
