"""Sliding (lookback, horizon) windows and chronological splits.

A window is identified by (key, sample_index): its last past row is the row
at ``row_position = sample_index + lookback - 1``. Instead of materialising
the 30x7 arrays, the long ``horizon_rows`` form (one row per window x day)
is built from the TARGET row with ``lag`` only: for target row t and day d,
the anchor is t - d, the last value is Sales[t-d] and the weekly-seasonal
value is Sales[t - 7 * ceil(d / 7)], never a row after the anchor. The input arrays of models are cut from time blocks
(``blocks``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import WindowParams


def _counts(n: Column, wp: WindowParams) -> dict[str, Column]:
    n_windows = F.greatest(n - wp.lookback - wp.horizon + 1, F.lit(0))
    train_size = F.floor(n_windows * F.lit(wp.train_fraction)).cast("int")
    fit_size = F.floor(train_size * F.lit(1 - wp.validation_fraction)).cast("int")
    return {"n_windows": n_windows.cast("int"), "train_size": train_size, "fit_size": fit_size}


def split_label(sample_index: Column, train_size: Column, fit_size: Column | None = None) -> Column:
    """'train' / 'test' (chronological); with ``fit_size``: 'train' / 'val' / 'test'."""
    lab = F.when(sample_index >= train_size, "test")
    if fit_size is not None:
        lab = lab.when(sample_index >= fit_size, "val")
    return lab.otherwise("train")


def window_index(feat: DataFrame, wp: WindowParams = WindowParams(), key: str = "Store",
                 order: str = "Date") -> DataFrame:
    """One row per window: key, sample_index, anchor date, first target date, split."""
    w = Window.partitionBy(key).orderBy(order)
    c = _counts(F.col("n_rows"), wp)
    idx = feat.select(
        key, F.col(order).alias("anchor_date"),
        F.lead(order, 1).over(w).alias("first_target_date"),
        (F.col("row_position") - (wp.lookback - 1)).cast("int").alias("sample_index"),
        *[v.alias(k) for k, v in c.items()])
    idx = idx.filter((F.col("sample_index") >= 0) & (F.col("sample_index") < F.col("n_windows")))
    return idx.select(key, "sample_index", "anchor_date", "first_target_date",
                      split_label(F.col("sample_index"), F.col("train_size")).alias("split"),
                      split_label(F.col("sample_index"), F.col("train_size"), F.col("fit_size")).alias("split3"),
                      "n_windows", "train_size")


def horizon_rows(feat: DataFrame, wp: WindowParams = WindowParams(), key: str = "Store",
                 order: str = "Date", target: str = "Sales", extra: list[str] | None = None) -> DataFrame:
    """Long form: one row per (window, forecast_day) with the actual value and
    the two naive baselines. ``extra`` columns of the TARGET row ride along
    (known-future features)."""
    w = Window.partitionBy(key).orderBy(order)
    y = F.col(target).cast("double")
    c = _counts(F.col("n_rows"), wp)
    # the same weekday last seen at the anchor: 7 rows back, 14 for days 8..14, ...
    lags = F.array(*[F.struct(F.lit(d).alias("forecast_day"), F.lag(y, d).over(w).alias("last_value"),
                              F.lag(y, 7 * -(-d // 7)).over(w).alias("weekly_seasonal"))
                     for d in range(1, wp.horizon + 1)])
    extra = extra or []
    base = feat.select(key, F.col(order).alias("target_date"), "row_position",
                       y.alias("actual_sales"), lags.alias("_lags"), *extra, *[v.alias(k) for k, v in c.items()])
    rows = base.select("*", F.inline("_lags")).drop("_lags")
    rows = rows.withColumn("sample_index",
                           (F.col("row_position") - F.col("forecast_day") - (wp.lookback - 1)).cast("int"))
    rows = rows.filter((F.col("sample_index") >= 0) & (F.col("sample_index") < F.col("n_windows")))
    return rows.select(
        key, "sample_index", F.col("forecast_day").cast("int").alias("forecast_day"),
        F.col("forecast_day").cast("int").alias("forecast_day_i"), "target_date",
        (F.col("row_position")).alias("target_row"), "actual_sales", "last_value", "weekly_seasonal",
        split_label(F.col("sample_index"), F.col("train_size")).alias("split"),
        split_label(F.col("sample_index"), F.col("train_size"), F.col("fit_size")).alias("split3"),
        "train_size", *extra)


def sliding_windows(feat: DataFrame, value_cols: list[str], wp: WindowParams = WindowParams(),
                    key: str = "Store", order: str = "Date", future_cols: list[str] | None = None,
                    target: str = "Sales") -> DataFrame:
    """Array windows: ``past`` = lookback structs of ``value_cols``, ``future``
    = horizon structs of ``future_cols`` (known ahead), ``y`` = horizon targets."""
    w = Window.partitionBy(key).orderBy(order)
    c = _counts(F.col("n_rows"), wp)
    past = F.collect_list(F.struct(*value_cols)).over(w.rowsBetween(-(wp.lookback - 1), 0))
    ahead = w.rowsBetween(1, wp.horizon)
    cols = [key, F.col(order).alias("anchor_date"),
            (F.col("row_position") - (wp.lookback - 1)).cast("int").alias("sample_index"),
            past.alias("past"),
            F.collect_list(F.col(target)).over(ahead).alias("y"),
            *[v.alias(k) for k, v in c.items()]]
    if future_cols:
        cols.append(F.collect_list(F.struct(*future_cols)).over(ahead).alias("future"))
    out = feat.select(*cols).filter((F.col("sample_index") >= 0) & (F.col("sample_index") < F.col("n_windows")))
    return out.withColumn("split", split_label(F.col("sample_index"), F.col("train_size"))).drop(
        "n_windows", "fit_size")


def latest_window(feat: DataFrame, lookback: int = 30, key: str = "Store", order: str = "Date") -> DataFrame:
    """The last ``lookback`` rows of each series (the inference context)."""
    return feat.filter(F.col("row_position") >= F.col("n_rows") - lookback)


def latest_state(feat: DataFrame, key: str = "Store", with_tail: bool = False,
                 extra_aggs: list[Column] | None = None) -> DataFrame:
    """Per series, ONE aggregation (reusing the feature partitioning): latest
    date, its rolling values, promo counter and Sales, the mean of the last 7
    Sales, the Sunday rule; with ``with_tail`` also the last 8 (Date, Sales)
    pairs — the only rows a calendar lag-7 from the horizon can hit."""
    last = F.col("row_position") == F.col("n_rows") - 1
    tail7 = F.col("row_position") >= F.col("n_rows") - 7
    tail8 = F.col("row_position") >= F.col("n_rows") - 8

    def at_last(c: str) -> Column:
        return F.max(F.when(last, F.col(c)))

    aggs = [
        F.max("Date").alias("latest_date"),
        at_last("rolling_7_sales").alias("last_rolling_7_sales"),
        at_last("rolling_14_sales").alias("last_rolling_14_sales"),
        at_last("rolling_7_std_sales").alias("last_rolling_7_std_sales"),
        at_last("days_since_last_promo").alias("last_days_since_promo"),
        at_last("Sales").cast("double").alias("last_sales"),
        F.avg(F.when(tail7, F.col("Sales"))).alias("tail7_mean"),
        (F.max((F.col("DayOfWeek") == 7).cast("int")) == 0).alias("closes_on_sundays"),
    ]
    if with_tail:
        aggs.append(F.collect_list(F.when(tail8, F.struct(F.col("Date").alias("d"),
                                                          F.col("Sales").cast("double").alias("s"))))
                    .alias("tail"))
    return feat.groupBy(key).agg(*aggs, *(extra_aggs or []))


def with_positions(df: DataFrame, key: str, order: str) -> DataFrame:
    """0-based ``row_position`` and ``n_rows`` per series (one window pass)."""
    w = Window.partitionBy(key).orderBy(order)
    return df.select("*", (F.row_number().over(w) - 1).alias("row_position"),
                     F.count(F.lit(1)).over(Window.partitionBy(key)).alias("n_rows"))
