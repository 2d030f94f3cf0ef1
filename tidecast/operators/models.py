"""Direct multi-horizon demand models with Spark ML (re-aim of the network
trainers): one long row per (window, forecast day), features known at the
window's anchor (last value, same weekday last week, horizon day) plus the
target day's known-ahead calendar / promo features. Training, early stopping
(GBT validation indicator on the chronological validation split) and scoring
all run distributed on the JVM; no Python in the hot path.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scaling as sc

KNOWN_AHEAD = ["Promo", "SchoolHoliday", "DayOfWeek", "IsWeekend", "Month", "is_month_start", "is_month_end",
               "is_april", "promo_schoolholiday", "weekend_schoolholiday", "promo_weekend",
               "days_since_last_promo", "days_until_next_promo"]
MODEL_FEATURES = ["last_value", "weekly_seasonal", "forecast_day"] + KNOWN_AHEAD


def training_rows(h: DataFrame, promo_cap: int | None = None, key: str = "Store") -> DataFrame:
    """Horizon rows -> model rows: doubles everywhere, the residual label standard-
    scaled per series over its train rows, the validation indicator. Promo counters
    are as in the history (uncapped) unless ``promo_cap`` is given."""
    capped = {} if promo_cap is None else {
        c: F.least(F.col(c), F.lit(promo_cap)) for c in ("days_since_last_promo", "days_until_next_promo")}
    cols = [capped.get(c, F.col(c)).cast("double").alias(c) for c in MODEL_FEATURES]
    residual = F.col("actual_sales") - F.col("weekly_seasonal")
    fitted = F.when(F.col("split") == "train", residual)
    whole = Window.partitionBy(key)
    mean, std = F.avg(fitted).over(whole), F.stddev_pop(fitted).over(whole)
    return h.select(key, "sample_index", "forecast_day_i", "target_date", "split", "split3", "actual_sales", *cols,
                    sc.standard_transform(residual, mean, std).alias("residual"),
                    mean.alias("residual_mean"), std.alias("residual_std")) \
            .withColumn("is_val", F.col("split3") == "val")


def linear_pipeline(label: str = "actual_sales", reg: float = 0.1) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features", handleInvalid="error"),
        # normal equations: ONE distributed pass (a small feature Gram matrix)
        # instead of one pass per L-BFGS iteration
        LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                         solver="normal", predictionCol="prediction")])


def gbt_pipeline(label: str = "actual_sales", max_iter: int = 30, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features", handleInvalid="error"),
        GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=4, stepSize=0.1,
                     subsamplingRate=0.8, seed=seed, validationIndicatorCol="is_val", validationTol=0.001,
                     predictionCol="prediction")])


def fit_rows(rows: DataFrame) -> DataFrame:
    """The rows a fit may see: train + val (val drives GBT early stopping), never test."""
    return rows.filter(F.col("split") == "train")


def fit(rows: DataFrame, pipeline: Pipeline) -> PipelineModel:
    return pipeline.fit(fit_rows(rows))


def score(model: PipelineModel, rows: DataFrame, residual: bool = False) -> DataFrame:
    """Score rows; a residual model adds its output, scaled back, to the weekly
    baseline. Predictions are clipped at 0 (demand is never negative)."""
    out = model.transform(rows)
    back = sc.standard_inverse(F.col("prediction"), F.col("residual_mean"), F.col("residual_std"))
    pred = F.col("weekly_seasonal") + back if residual else F.col("prediction")
    return out.withColumn("model_prediction", F.greatest(pred, F.lit(0.0))).drop("features", "prediction")


def score_with_predict_fn(rows: DataFrame, make_predict_fn, batch_size: int = 4096,
                          features: list[str] | None = None, out: str = "model_prediction") -> DataFrame:
    """Score any Python model (an exported network, ONNX, numpy weights) with
    ``predict_batch_udf``: Arrow batches of ``batch_size`` rows, the model
    built once per Python worker by ``make_predict_fn`` (it returns a
    ``numpy [n, k] -> numpy [n]`` function). Used when the model is not a
    Spark ML pipeline."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType

    cols = features or MODEL_FEATURES
    udf = predict_batch_udf(make_predict_fn, return_type=DoubleType(), batch_size=batch_size,
                            input_tensor_shapes=[[len(cols)]])
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    return rows.withColumn(out, F.greatest(udf(vec), F.lit(0.0)))


def linear_predict_fn(model: PipelineModel):
    """A ``make_predict_fn`` reproducing a fitted linear pipeline in numpy
    (coefficients captured on the driver: a few doubles)."""
    lr = model.stages[-1]
    coef = list(lr.coefficients.toArray())
    intercept = float(lr.intercept)

    def make():
        import numpy as np
        w = np.asarray(coef, dtype="float64")

        def predict(x):
            return x @ w + intercept
        return predict
    return make


def fixed_predict_fn(weights: list[float], intercept: float = 0.0):
    """A ``make_predict_fn`` for given linear weights (one per feature column)."""
    def make():
        import numpy as np
        w = np.asarray(weights, dtype="float64")

        def predict(x):
            return x @ w + intercept
        return predict
    return make
