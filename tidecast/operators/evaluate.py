"""Forecast evaluation: prediction records, metrics, comparisons, top-K,
error diagnosis by business context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import abs_error, pct_error
from ..params import WindowParams


def prediction_records(h: DataFrame, pred_col: str, split: str | None = "test",
                       policy: str = "mask", key: str = "Store", extra: Sequence[str] = ()) -> DataFrame:
    """Long prediction records for one method: key, sample_index (global),
    test_index (0-based within the split), forecast_day, actual_sales,
    predicted_sales, absolute_error, percentage_error."""
    df = h if split is None else h.filter(F.col("split") == split)
    a, p = F.col("actual_sales"), F.col(pred_col).cast("double")
    first = F.col("train_size") if split == "test" else F.lit(0)
    return df.select(
        key, "sample_index", (F.col("sample_index") - first).cast("int").alias("test_index"),
        "forecast_day", "target_date", a.alias("actual_sales"), p.alias("predicted_sales"),
        abs_error(a, p).alias("absolute_error"), pct_error(a, p, policy).alias("percentage_error"), *extra)


def metric_aggs(actual: str = "actual_sales", pred: str = "predicted_sales",
                policy: str = "mask") -> list[Column]:
    a, p = F.col(actual), F.col(pred)
    return [F.avg(abs_error(a, p)).alias("mae"),
            F.sqrt(F.avg((a - p) * (a - p))).alias("rmse"),
            F.avg(pct_error(a, p, policy)).alias("mape"),
            F.count(F.lit(1)).alias("n_points")]


def error_metrics(preds: DataFrame, by: Sequence[str] = (), policy: str = "mask") -> DataFrame:
    """MAE / RMSE / MAPE(%) per group (overall when ``by`` is empty)."""
    g = preds.groupBy(*by) if by else preds.groupBy()
    return g.agg(*metric_aggs(policy=policy))


def methods_long(h: DataFrame, methods: dict[str, str], key: str = "Store") -> DataFrame:
    """Stack the predictions of several methods into a ``method`` column with
    one narrow ``inline`` (no union, one scan)."""
    arr = F.array(*[F.struct(F.lit(m).alias("method"), F.col(c).cast("double").alias("predicted_sales"))
                    for m, c in methods.items()])
    keep = [c for c in h.columns if c not in methods.values()]
    return h.select(*keep, F.inline(arr))


def compare_methods(h: DataFrame, methods: dict[str, str], by: Sequence[str] = ("Store",),
                    split: str = "test", policy: str = "mask") -> DataFrame:
    long = methods_long(h.filter(F.col("split") == split), methods)
    return long.groupBy(*by, "method").agg(*metric_aggs(policy=policy))


def champion_selection(metrics: DataFrame, by: Sequence[str] = ("Store",)) -> DataFrame:
    """Per group: champion = lowest MAPE (ties: method name); for every method
    the MAPE gap (pp) to the champion and whether the champion beats it."""
    w = Window.partitionBy(*by)
    best = F.min_by(F.col("method"), F.struct("mape", "method")).over(w)
    best_mape = F.min("mape").over(w)
    return metrics.select(
        *by, "method", "mape", best.alias("champion"),
        (F.col("mape") - best_mape).alias("gain_pp"),
        F.when(best_mape < F.col("mape"), "YES").otherwise("NO").alias("champion_beats"))


def lift_over_baseline(metrics: DataFrame, model: str, baseline: str,
                       by: Sequence[str] = ("Store",)) -> DataFrame:
    """baseline - model per metric; positive = Improved (conditional aggregation,
    no self join)."""
    def pick(m: str, name: str) -> Column:
        return F.max(F.when(F.col("method") == name, F.col(m)))

    g = metrics.groupBy(*by).agg(*[(pick(m, baseline) - pick(m, model)).alias(f"{m}_lift")
                                   for m in ("mae", "rmse", "mape")])
    return g.select("*", *[F.when(F.col(f"{m}_lift") > 0, "Improved").otherwise("Degraded").alias(f"{m}_status")
                           for m in ("mae", "rmse", "mape")])


def worst_predictions(preds: DataFrame, k: int = 20, per: str | None = None) -> DataFrame:
    """Top-K by absolute error with a total tie order. Global: TakeOrderedAndProject
    (per-partition top-K, then merge of K rows per partition); per group: row_number."""
    order = [F.col("absolute_error").desc(), F.col("Store"), F.col("sample_index"), F.col("forecast_day")]
    if per is None:
        return preds.orderBy(*order).limit(k)
    w = Window.partitionBy(per).orderBy(*order)
    return preds.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


CONTEXT_COLUMNS = ["Date", "DayOfWeek", "Month", "Day", "Promo", "SchoolHoliday",
                   "IsWeekend", "Sales", "lag_7_sales", "rolling_7_sales"]


def join_error_context(preds: DataFrame, feat: DataFrame, wp: WindowParams = WindowParams(),
                       cols: Sequence[str] = CONTEXT_COLUMNS) -> DataFrame:
    """Attach the TARGET row's context to each prediction: an equi join on
    (Store, row_position = sample_index + lookback + forecast_day - 1); no
    positional concat. Out-of-range targets get NULL context (LEFT join)."""
    ctx = feat.select("Store", F.col("row_position").alias("_row"), *cols)
    row = (F.col("sample_index") + wp.lookback + F.col("forecast_day") - 1).cast("int")
    return preds.withColumn("_row", row).join(ctx, ["Store", "_row"], "left").drop("_row")


def drop_unmatched_context(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Date").isNotNull())


LABELS = {
    "Promo": {0: "No Promo", 1: "Promo Active"},
    "IsWeekend": {0: "Weekday", 1: "Weekend"},
}


def error_by(df: DataFrame, col: str, by: Sequence[str] = ("Store",)) -> DataFrame:
    """Mean absolute error per context group, with a label."""
    labels = LABELS.get(col)
    if labels:
        label = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in labels.items()
                                                       for x in (F.lit(k), F.lit(v))]), F.col(col)),
                           F.col(col).cast("string"))
    elif col == "DayOfWeek":
        label = F.concat(F.lit("Day "), F.col(col).cast("string"))
    elif col == "Month":
        label = F.concat(F.lit("Month "), F.lpad(F.col(col).cast("string"), 2, "0"))
    else:
        label = F.col(col).cast("string")
    return df.groupBy(*by, col).agg(F.avg("absolute_error").alias("mean_abs_error"),
                                    F.first(label).alias("label"),
                                    F.count(F.lit(1)).alias("n_points"))


def pivot_predictions(preds: DataFrame, horizon: int = 7, key: Sequence[str] = ("Store", "test_index")) -> DataFrame:
    """Long -> wide report ``Day_k_Actual / Day_k_Pred`` with Mean_MAE / Mean_MAPE
    per sample in ONE aggregation (conditional aggregates; no pivot
    distinct-values job, no second aggregation, no join)."""
    d = F.col("forecast_day")
    cells = [a for k in range(1, horizon + 1) for a in (
        F.max(F.when(d == k, F.col("actual_sales"))).alias(f"Day_{k}_Actual"),
        F.max(F.when(d == k, F.col("predicted_sales"))).alias(f"Day_{k}_Pred"))]
    return preds.groupBy(*key).agg(*cells, F.avg("absolute_error").alias("Mean_MAE"),
                                   F.avg("percentage_error").alias("Mean_MAPE"))


def unpivot_predictions(wide: DataFrame, horizon: int = 7, key: Sequence[str] = ("Store", "test_index")) -> DataFrame:
    """Wide ``Day_k_*`` -> long (key, forecast_day, actual, predicted) via one inline."""
    arr = F.array(*[F.struct(F.lit(d).alias("forecast_day"),
                             F.col(f"Day_{d}_Actual").alias("actual_sales"),
                             F.col(f"Day_{d}_Pred").alias("predicted_sales"))
                    for d in range(1, horizon + 1)])
    return wide.select(*key, F.inline(arr))
