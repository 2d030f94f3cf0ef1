"""Queries: naive baselines, prediction records, metrics, comparisons,
champion selection, top-K and error diagnosis (SURVEY 2.4, 2.6, 2.7, 2.9
baselines)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scaling as scf
from ..functions.metrics import pct_error as pct_expr
from ..operators import evaluate as ev
from ..operators import windows
from ..sources import files
from . import tables
from .oracle import sql
from .registry import r4, register

METHODS = {"last_value": "last_value", "weekly_seasonal": "weekly_seasonal"}


def _h(spark, sf):
    return windows.horizon_rows(tables.feature_table(spark, sf))


def _preds(spark, sf, col="weekly_seasonal", policy="mask"):
    return ev.prediction_records(_h(spark, sf), col, policy=policy)


_PRED_COLS = ("Store, sample_index, test_index, forecast_day, target_date, actual_sales, predicted_sales, "
              "absolute_error, ROUND(percentage_error, 4) AS percentage_error")


def _out(df):
    return df.select("Store", "sample_index", "test_index", "forecast_day", "target_date", "actual_sales",
                     "predicted_sales", "absolute_error", r4("percentage_error").alias("percentage_error"))


@register("baseline_last_value", sql(f"SELECT {_PRED_COLS} FROM preds_last", "preds_last"))
def baseline_last_value(spark, sf):
    """Last past Sales repeated for all 7 days; test prediction records."""
    return _out(_preds(spark, sf, "last_value"))


@register("baseline_weekly_seasonal", sql(f"SELECT {_PRED_COLS} FROM preds_weekly", "preds_weekly"))
def baseline_weekly_seasonal(spark, sf):
    """Day d = the Sales 7 rows before the target; test prediction records."""
    return _out(_preds(spark, sf))


@register("abs_error", sql("SELECT Store, sample_index, forecast_day, absolute_error FROM preds_weekly",
                           "preds_weekly"))
def abs_error(spark, sf):
    """|actual - predicted| per prediction."""
    return _preds(spark, sf).select("Store", "sample_index", "forecast_day", "absolute_error")


@register("pct_error", sql("""
SELECT Store, sample_index, forecast_day,
       ROUND(CASE WHEN actual_sales <> 0 THEN abs(actual_sales - predicted_sales) / abs(actual_sales) * 100 END, 4) AS pct_mask,
       ROUND(abs(actual_sales - predicted_sales) / (abs(actual_sales) + 1e-8) * 100, 4) AS pct_epsilon,
       ROUND(CASE WHEN actual_sales <> 0 THEN abs(actual_sales - predicted_sales) / abs(actual_sales) END * 100, 4) AS pct_raw
FROM preds_weekly""", "preds_weekly"))
def pct_error(spark, sf):
    """Absolute percentage error under the three zero policies."""
    p = _preds(spark, sf)
    a, q = F.col("actual_sales"), F.col("predicted_sales")
    return p.select("Store", "sample_index", "forecast_day",
                    *[r4(pct_expr(a, q, pol)).alias(f"pct_{pol}") for pol in ("mask", "epsilon", "raw")])


_MET = "ROUND(mae, 4) AS mae, ROUND(rmse, 4) AS rmse, ROUND(mape, 4) AS mape, n_points"


def _met(df, *keys):
    return df.select(*keys, r4("mae").alias("mae"), r4("rmse").alias("rmse"), r4("mape").alias("mape"), "n_points")


_AGG = """avg(absolute_error) AS mae, sqrt(avg(absolute_error * absolute_error)) AS rmse,
       avg(percentage_error) AS mape, count(*) AS n_points"""


@register("error_metrics", sql(f"SELECT Store, {_MET} FROM (SELECT Store, {_AGG} FROM preds_weekly GROUP BY Store)",
                               "preds_weekly"))
def error_metrics(spark, sf):
    """MAE / RMSE / MAPE of the weekly-seasonal baseline per store (test)."""
    return _met(ev.error_metrics(_preds(spark, sf), ["Store"]), "Store")


@register("error_by_horizon", sql(f"""
SELECT Store, forecast_day, {_MET} FROM (SELECT Store, forecast_day, {_AGG} FROM preds_weekly GROUP BY 1, 2)""",
                                  "preds_weekly"))
def error_by_horizon(spark, sf):
    """Metrics per store and forecast day 1..7."""
    return _met(ev.error_metrics(_preds(spark, sf), ["Store", "forecast_day"]), "Store", "forecast_day")


@register("error_by_sample", sql("""
SELECT Store, test_index, ROUND(avg(absolute_error), 4) AS Mean_MAE, ROUND(avg(percentage_error), 4) AS Mean_MAPE
FROM preds_weekly GROUP BY 1, 2""", "preds_weekly"))
def error_by_sample(spark, sf):
    """Mean MAE / MAPE per test window."""
    return _preds(spark, sf).groupBy("Store", "test_index").agg(
        r4(F.avg("absolute_error")).alias("Mean_MAE"), r4(F.avg("percentage_error")).alias("Mean_MAPE"))


@register("compare_methods", sql(f"SELECT Store, method, {_MET} FROM method_metrics", "method_metrics"))
def compare_methods(spark, sf):
    """Metrics of every method per store from ONE long table (inline, one groupBy)."""
    return _met(ev.compare_methods(_h(spark, sf), METHODS), "Store", "method")


@register("union_methods", sql(f"""
SELECT method, {_MET} FROM (
  SELECT 'last_value' AS method, {_AGG} FROM preds_last
  UNION ALL SELECT 'weekly_seasonal' AS method, {_AGG} FROM preds_weekly)""", "preds_last", "preds_weekly"))
def union_methods(spark, sf):
    """Per-method metric rows stacked with unionByName (the shared window
    horizon table is checkpointed once and read by both branches)."""
    h = tables.reused(spark, _h(spark, sf))
    parts = [ev.error_metrics(ev.prediction_records(h, col), []).withColumn("method", F.lit(m))
             for m, col in METHODS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _met(out, "method")


@register("champion_selection", sql("""
SELECT Store, method, ROUND(mape, 4) AS mape, min_by(method, struct_pack(mape, method)) OVER (PARTITION BY Store) AS champion,
       ROUND(mape - min(mape) OVER (PARTITION BY Store), 4) AS gain_pp,
       CASE WHEN min(mape) OVER (PARTITION BY Store) < mape THEN 'YES' ELSE 'NO' END AS champion_beats
FROM method_metrics""", "method_metrics"))
def champion_selection(spark, sf):
    """Lowest-MAPE method per store and the MAPE gap of every competitor."""
    c = ev.champion_selection(ev.compare_methods(_h(spark, sf), METHODS))
    return c.select("Store", "method", r4("mape").alias("mape"), "champion", r4("gain_pp").alias("gain_pp"),
                    "champion_beats")


@register("lift_over_baseline", sql("""
SELECT Store, ROUND(b.mae - m.mae, 4) + 0.0 AS mae_lift, ROUND(b.rmse - m.rmse, 4) + 0.0 AS rmse_lift,
       ROUND(b.mape - m.mape, 4) + 0.0 AS mape_lift,
       CASE WHEN b.mae - m.mae > 0 THEN 'Improved' ELSE 'Degraded' END AS mae_status,
       CASE WHEN b.rmse - m.rmse > 0 THEN 'Improved' ELSE 'Degraded' END AS rmse_status,
       CASE WHEN b.mape - m.mape > 0 THEN 'Improved' ELSE 'Degraded' END AS mape_status
FROM (SELECT * FROM method_metrics WHERE method = 'weekly_seasonal') m
JOIN (SELECT * FROM method_metrics WHERE method = 'last_value') b USING (Store)""", "method_metrics"))
def lift_over_baseline(spark, sf):
    """Baseline minus model per metric (weekly-seasonal vs last-value)."""
    lift = ev.lift_over_baseline(ev.compare_methods(_h(spark, sf), METHODS), "weekly_seasonal", "last_value")
    return lift.select("Store", *[r4(f"{m}_lift").alias(f"{m}_lift") for m in ("mae", "rmse", "mape")],
                       "mae_status", "rmse_status", "mape_status")


@register("worst_predictions", sql(f"""
SELECT {_PRED_COLS} FROM preds_weekly ORDER BY absolute_error DESC, Store, sample_index, forecast_day LIMIT 20""",
                                   "preds_weekly"))
def worst_predictions(spark, sf):
    """Top-20 absolute errors (a top-k report: the limit is the feature)."""
    return _out(ev.worst_predictions(_preds(spark, sf), 20))


_CTX = "Date, DayOfWeek, Month, Day, Promo, SchoolHoliday, IsWeekend, Sales, lag_7_sales, ROUND(rolling_7_sales, 4) AS rolling_7_sales"


def _ctx_out(df):
    return df.select("Store", "sample_index", "forecast_day", "actual_sales", "predicted_sales", "absolute_error",
                     r4("percentage_error").alias("percentage_error"), "Date", "DayOfWeek", "Month", "Day", "Promo",
                     "SchoolHoliday", "IsWeekend", "Sales", "lag_7_sales", r4("rolling_7_sales").alias("rolling_7_sales"))


@register("worst_predictions_context", sql(f"""
SELECT Store, sample_index, forecast_day, actual_sales, predicted_sales, absolute_error,
       ROUND(percentage_error, 4) AS percentage_error, {_CTX}
FROM context ORDER BY absolute_error DESC, Store, sample_index, forecast_day LIMIT 20""", "context"))
def worst_predictions_context(spark, sf):
    """Top-20 errors enriched with the business context of the target day.
    The context rides along the horizon rows (built from the target row), so
    the feature table is computed once; then a top-K."""
    return _ctx_out(ev.worst_predictions(_preds_with_context(spark, sf), 20))


def _preds_with_context(spark, sf):
    """Prediction records + target-row context in ONE pass over the features
    (same values as ``join_error_context``, without the second feature scan)."""
    feat = tables.feature_table(spark, sf)
    ctx = [c for c in ev.CONTEXT_COLUMNS if c not in ("Date", "Sales")]
    h = windows.horizon_rows(feat, extra=ctx)
    p = ev.prediction_records(h, "weekly_seasonal", extra=ctx)
    return p.withColumn("Date", F.col("target_date")).withColumn("Sales", F.col("actual_sales").cast("bigint"))


@register("join_error_context", sql(f"""
SELECT Store, sample_index, forecast_day, actual_sales, predicted_sales, absolute_error,
       ROUND(percentage_error, 4) AS percentage_error, {_CTX} FROM context""", "context"))
def join_error_context(spark, sf):
    """Every test prediction with its target row's context (equi join on
    (Store, row_position), not positional). The feature table feeds both
    sides, so it is checkpointed once."""
    feat = tables.reused(spark, tables.feature_table(spark, sf))
    p = ev.prediction_records(windows.horizon_rows(feat), "weekly_seasonal")
    return _ctx_out(ev.join_error_context(p, feat))


@register("drop_unmatched_context", sql(f"""
SELECT Store, sample_index, forecast_day, actual_sales, predicted_sales, absolute_error,
       ROUND(percentage_error, 4) AS percentage_error, {_CTX} FROM context WHERE Date IS NOT NULL""", "context"))
def drop_unmatched_context(spark, sf):
    """Predictions whose context row exists."""
    feat = tables.reused(spark, tables.feature_table(spark, sf))
    p = ev.prediction_records(windows.horizon_rows(feat), "weekly_seasonal")
    return _ctx_out(ev.drop_unmatched_context(ev.join_error_context(p, feat)))


def _by(col: str, label_sql: str):
    def build(spark, sf):
        ctx = ev.drop_unmatched_context(_preds_with_context(spark, sf))
        return ev.error_by(ctx, col).select("Store", col, "label", r4("mean_abs_error").alias("mean_abs_error"),
                                            "n_points")
    build.__doc__ = f"Mean absolute error per store and {col}, labelled."
    register(f"error_by_{col.lower() if col != 'IsWeekend' else 'weekend'}".replace("dayofweek", "dow"), sql(f"""
SELECT Store, {col}, {label_sql} AS label, ROUND(avg(absolute_error), 4) AS mean_abs_error, count(*) AS n_points
FROM context WHERE Date IS NOT NULL GROUP BY Store, {col}""", "context"))(build)


_by("Promo", "CASE Promo WHEN 0 THEN 'No Promo' WHEN 1 THEN 'Promo Active' ELSE CAST(Promo AS VARCHAR) END")
_by("IsWeekend", "CASE IsWeekend WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Weekend' ELSE CAST(IsWeekend AS VARCHAR) END")
_by("DayOfWeek", "'Day ' || CAST(DayOfWeek AS VARCHAR)")
_by("Month", "'Month ' || lpad(CAST(Month AS VARCHAR), 2, '0')")


@register("first_sample_compare", sql("""
SELECT Store, forecast_day, round_even(actual_sales, 1) AS actual, round_even(weekly_seasonal, 1) AS weekly_baseline,
       round_even(last_value, 1) AS last_value
FROM horizon WHERE split = 'test' AND sample_index = train_size""", "horizon"))
def first_sample_compare(spark, sf):
    """Actual vs both baselines on each store's first test window, 1 decimal."""
    h = _h(spark, sf)
    first = h.filter((F.col("split") == "test") & (F.col("sample_index") == F.col("train_size")))
    return first.select("Store", "forecast_day", F.bround("actual_sales", 1).alias("actual"),
                        F.bround("weekly_seasonal", 1).alias("weekly_baseline"),
                        F.bround("last_value", 1).alias("last_value"))


@register("first_n_samples_flat", sql("""
SELECT Store, test_index, forecast_day, actual_sales, predicted_sales FROM preds_weekly WHERE test_index < 30""",
                                      "preds_weekly"))
def first_n_samples_flat(spark, sf):
    """First 30 test windows flattened (actual vs predicted)."""
    p = _preds(spark, sf)
    return p.filter(F.col("test_index") < 30).select("Store", "test_index", "forecast_day", "actual_sales",
                                                     "predicted_sales")


def _wide_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN forecast_day = {d} THEN actual_sales END) AS Day_{d}_Actual, "
                     f"max(CASE WHEN forecast_day = {d} THEN predicted_sales END) AS Day_{d}_Pred" for d in range(1, 8))
    return (f"SELECT Store, test_index, {cols}, ROUND(avg(absolute_error), 4) AS Mean_MAE, "
            f"ROUND(avg(percentage_error), 4) AS Mean_MAPE FROM preds_weekly GROUP BY Store, test_index")


@register("pivot_predictions", sql(_wide_sql(), "preds_weekly"))
def pivot_predictions(spark, sf):
    """Long records -> wide Day_k_Actual / Day_k_Pred report per window."""
    w = ev.pivot_predictions(_preds(spark, sf))
    return w.withColumn("Mean_MAE", r4("Mean_MAE")).withColumn("Mean_MAPE", r4("Mean_MAPE"))


@register("unpivot_predictions", sql("""
SELECT Store, test_index, forecast_day, actual_sales, predicted_sales FROM preds_weekly""", "preds_weekly"))
def unpivot_predictions(spark, sf):
    """Wide report -> long records (round trip of the pivot)."""
    return ev.unpivot_predictions(ev.pivot_predictions(_preds(spark, sf)))


@register("stack_batches", sql("""
SELECT Store, CAST(test_index // 16 AS INTEGER) AS batch, test_index, forecast_day, predicted_sales
FROM preds_weekly""", "preds_weekly"))
def stack_batches(spark, sf):
    """Predictions with their inference batch (16 windows per batch)."""
    p = _preds(spark, sf)
    return p.select("Store", F.floor(F.col("test_index") / 16).cast("int").alias("batch"), "test_index",
                    "forecast_day", "predicted_sales")


@register("test_mse_scaled", sql("""
SELECT p.Store, ROUND(avg(((p.actual_sales - s.lo) / s.rng - (p.predicted_sales - s.lo) / s.rng)
                          * ((p.actual_sales - s.lo) / s.rng - (p.predicted_sales - s.lo) / s.rng)), 6) AS test_mse
FROM preds_weekly p JOIN (
  SELECT Store, CAST(min(Sales) AS DOUBLE) AS lo,
         CASE WHEN max(Sales) = min(Sales) THEN 1.0 ELSE CAST(max(Sales) - min(Sales) AS DOUBLE) END AS rng
  FROM features GROUP BY Store) s ON p.Store = s.Store
GROUP BY p.Store""", "preds_weekly", "features"))
def test_mse_scaled(spark, sf):
    """MSE of the scaled predictions per store (target scaler fitted per store
    with window aggregates on the feature partitioning: no join)."""
    w = Window.partitionBy("Store")
    feat = tables.feature_table(spark, sf).select(
        "*", F.min(F.col("Sales").cast("double")).over(w).alias("_lo"),
        F.max(F.col("Sales").cast("double")).over(w).alias("_hi"))
    p = ev.prediction_records(windows.horizon_rows(feat, extra=["_lo", "_hi"]), "weekly_seasonal",
                              extra=["_lo", "_hi"])
    za = scf.minmax_transform(F.col("actual_sales"), F.col("_lo"), F.col("_hi"))
    zp = scf.minmax_transform(F.col("predicted_sales"), F.col("_lo"), F.col("_hi"))
    return p.groupBy("Store").agg(F.round(F.avg((za - zp) * (za - zp)), 6).alias("test_mse"))


@register("concat_columns", sql("""
SELECT w.Store, w.sample_index, w.forecast_day, w.predicted_sales AS weekly_pred, l.predicted_sales AS last_value_pred
FROM preds_weekly w JOIN preds_last l USING (Store, sample_index, forecast_day)""", "preds_weekly", "preds_last")
          .replace("horizon AS (", "horizon AS MATERIALIZED ("))
def concat_columns(spark, sf):
    """Two aligned prediction frames side by side, joined on explicit keys in one plan
    (the join reuses the partitioning by store)."""
    h = _h(spark, sf)
    k = ["Store", "sample_index", "forecast_day"]
    w = ev.prediction_records(h, "weekly_seasonal").select(*k, F.col("predicted_sales").alias("weekly_pred"))
    lv = ev.prediction_records(h, "last_value").select(*k, F.col("predicted_sales").alias("last_value_pred"))
    return w.join(lv, k)


@register("sink_predictions", sql(f"SELECT {_PRED_COLS} FROM preds_weekly", "preds_weekly"))
def sink_predictions(spark, sf):
    """Prediction records written to the shared folder and read back."""
    return _out(files.materialize(spark, _preds(spark, sf), "predictions"))


@register("src_predictions", sql("""
SELECT Store, ROUND(avg(absolute_error), 4) AS mae FROM preds_weekly GROUP BY Store""", "preds_weekly"))
def src_predictions(spark, sf):
    """Stored prediction records read back for diagnosis."""
    back = files.materialize(spark, _preds(spark, sf), "predictions_src")
    return back.groupBy("Store").agg(r4(F.avg("absolute_error")).alias("mae"))


@register("sink_metrics", sql(f"""
SELECT 'overall' AS report, Store, 0 AS forecast_day, metric, ROUND(value, 4) AS value FROM (
  SELECT Store, {_AGG} FROM preds_weekly GROUP BY Store) UNPIVOT (value FOR metric IN (mae, rmse, mape))
UNION ALL
SELECT 'by_horizon' AS report, Store, forecast_day, metric, ROUND(value, 4) AS value FROM (
  SELECT Store, forecast_day, {_AGG} FROM preds_weekly GROUP BY 1, 2) UNPIVOT (value FOR metric IN (mae, rmse, mape))""",
                              "preds_weekly"))
def sink_metrics(spark, sf):
    """Metric report as a long (report, Store, forecast_day, metric, value) table."""
    # both reports from one pass over the predictions
    both = _preds(spark, sf).groupingSets([["Store"], ["Store", "forecast_day"]], "Store", "forecast_day").agg(
        *ev.metric_aggs(), F.grouping("forecast_day").alias("_all"))
    both = both.withColumn("report", F.when(F.col("_all") == 1, "overall").otherwise("by_horizon")) \
        .withColumn("forecast_day", F.coalesce("forecast_day", F.lit(0)))
    long = both.unpivot(["report", "Store", "forecast_day"], ["mae", "rmse", "mape"], "metric", "value")
    long = long.select("report", "Store", F.col("forecast_day").cast("int").alias("forecast_day"), "metric",
                       r4("value").alias("value"))
    return files.materialize(spark, long, "metrics")


# ---- synthetic residual pipeline --------------------------------------------------------------

@register("residual_reconstruct", sql("""
SELECT product, sample_index, forecast_day, weekly_seasonal AS baseline,
       ROUND(weekly_seasonal + residual, 4) AS final_prediction, actual_sales
FROM syn_horizon WHERE split = 'test'""", "syn_horizon"))
def residual_reconstruct(spark, sf):
    """final = baseline + inverse-scaled residual (here the scaled true residual,
    so the reconstruction must return the actual)."""
    syn = tables.synthetic_feature_table(spark, sf)
    w = Window.partitionBy("product")
    m, s = F.avg("residual").over(w), F.stddev_pop("residual").over(w)
    syn = syn.withColumn("residual_scaled", scf.standard_transform(F.col("residual"), m, s)) \
             .withColumn("_m", m).withColumn("_s", s)
    h = windows.horizon_rows(syn, key="product", order="date", target="units_sold",
                             extra=["residual_scaled", "_m", "_s"])
    t = h.filter(F.col("split") == "test")
    final = F.col("weekly_seasonal") + scf.standard_inverse(F.col("residual_scaled"), F.col("_m"), F.col("_s"))
    return t.select("product", "sample_index", "forecast_day", F.col("weekly_seasonal").alias("baseline"),
                    r4(final).alias("final_prediction"), "actual_sales")
