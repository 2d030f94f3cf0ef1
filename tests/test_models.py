"""Spark ML direct-horizon models: fit on train, early stopping on val,
batch scoring; the Arrow-batched path equals the JVM path."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from tidecast.operators import models as md
from tidecast.operators import windows
from tidecast.plans import tables


def test_linear_model_scores_and_predict_batch_path(spark):
    h = windows.horizon_rows(tables.feature_table(spark, SF_SMALL), extra=md.KNOWN_AHEAD)
    rows = md.training_rows(h).cache()
    model = md.fit(rows, md.linear_pipeline())
    test = rows.filter(F.col("split") == "test")
    jvm = md.score(model, test).select("Store", "sample_index", "forecast_day_i",
                                       F.col("model_prediction").alias("a"))
    py = md.score_with_predict_fn(test, md.linear_predict_fn(model), batch_size=512).select(
        "Store", "sample_index", "forecast_day_i", F.col("model_prediction").alias("b"))
    j = jvm.join(py, ["Store", "sample_index", "forecast_day_i"])
    assert j.count() == test.count() > 0
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-6).count() == 0
    # the model is never fitted on test rows and beats the last-value baseline on them
    m = md.score(model, test).agg(F.avg(F.abs(F.col("actual_sales") - F.col("model_prediction"))).alias("model"),
                                  F.avg(F.abs(F.col("actual_sales") - F.col("last_value"))).alias("naive")).first()
    assert m.model < m.naive
    rows.unpersist()


def test_forecast_with_trained_model(spark):
    from tidecast.operators import forecast as fc
    from tidecast.plans import requests as rq
    feat = tables.feature_table(spark, SF_SMALL)
    h = windows.horizon_rows(feat, extra=md.KNOWN_AHEAD)
    model = md.fit(md.training_rows(h), md.linear_pipeline())
    state = fc.history_state(feat)
    out = fc.forecast_with_model(fc.forecast_joined(rq.scenario_requests(state)), model)
    n_states = state.count()
    assert out.count() == n_states * 5 * 7
    assert out.filter(F.col("model_predicted_sales") < 0).count() == 0
    # the Promo scenario differs from Normal only on its two promo days
    by = {(r.Store, r.request_id % 10, r.step): r.model_raw_prediction for r in out.collect()}
    stores = {k[0] for k in by}
    for s in stores:
        assert all(by[(s, 0, d)] == by[(s, 4, d)] for d in range(1, 8))        # twin scenarios agree
    # days_since/until promo are capped at 10 in the horizon, as in training
    assert out.filter(F.col("promo") == 1).count() == n_states * 2
