"""Streaming intake: every line ends in one sink, once, whatever it holds."""

from pyspark.sql import functions as F

from paths import SF_SMALL
from tidecast.operators import forecast as fc
from tidecast.plans import requests as rq
from tidecast.plans import tables
from tidecast.session import scratch_path
from tidecast.sources import files
from tidecast.streaming import intake

LINE = '{"request_id": %d, "Store": %d, "submitted_at": "2001-10-01 08:00:00", "forecast_days": 7%s}'


def _snapshot(spark):
    return files.materialize(spark, fc.history_state(tables.feature_table(spark, SF_SMALL)), "snap")


def _send(spark, inbox, name, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{inbox}/{name}")


def test_intake_resumes_from_checkpoint(spark):
    snap = _snapshot(spark)
    store = snap.first().Store
    inbox = scratch_path(spark, "inbox")
    _send(spark, inbox, "a", [LINE % (i, store, "") for i in range(5)])
    out = intake.run_intake(spark, inbox + "/*", snap)
    assert spark.read.parquet(out["history"]).count() == 5
    _send(spark, inbox, "b", [LINE % (9, store, "")])
    intake.run_intake(spark, inbox + "/*", snap, out["history"], out["rejected"], out["checkpoint"])
    assert sorted(r.id for r in spark.read.parquet(out["history"]).collect()) == [0, 1, 2, 3, 4, 9]


def test_no_request_is_lost_or_mistaken(spark):
    snap = _snapshot(spark)
    store = snap.first().Store
    bad = {1: ', "current_stock": "abc"', 2: ', "current_stock": 7.5', 3: ', "promo_dates": "2015-08-01"',
           4: ', "safety_stock_percentage": "lots"', 5: ', "forecast_open_days_only": null'}
    fields = {1: ["current_stock"], 2: ["current_stock"], 3: ["promo_dates"], 4: ["safety_stock_percentage"],
              5: ["forecast_open_days_only"]}
    lines = [LINE % (0, store, "")] + [LINE % (i, store, x) for i, x in bad.items()]
    lines += [LINE % (6, 999_999, ""), '{"request_id": 7, broken', "", '{"forecast_days": 7}',
              LINE % (8, store, ', "current_stock": "12"')]
    inbox = scratch_path(spark, "inbox")
    _send(spark, inbox, "a", lines)
    out = intake.run_intake(spark, inbox + "/*", snap)
    rejected = spark.read.parquet(out["rejected"]).collect()
    assert {r.request_id: r.errors for r in rejected if r.request_id} == {**fields, 6: ["Store"]}
    rest = {r.body: r.errors for r in rejected if r.request_id is None}
    assert rest == {'{"request_id": 7, broken': ["body", "forecast_days"],
                    '{"forecast_days": 7}': ["request_id", "Store", "submitted_at"]}
    assert sorted(r.id for r in spark.read.parquet(out["history"]).collect()) == [0, 8]


def test_a_replayed_batch_changes_nothing(spark):
    snap = _snapshot(spark)
    store = snap.first().Store
    batch = spark.createDataFrame([(LINE % (i, store, x),) for i, x in enumerate(["", ', "unit_price": "x"'])], "body string")
    h, r = scratch_path(spark, "h"), scratch_path(spark, "r")
    for _ in range(2):
        intake.process_batch(batch, 3, snap, h, r)
    intake.process_batch(batch.filter("false"), 4, snap, h, r)
    assert spark.read.parquet(h).count() == 1 and spark.read.parquet(r).count() == 1


def test_unknown_store_stays_in_built_forecasts(spark):
    snap = _snapshot(spark)
    req = rq.default_requests(snap).select("Store", "request_id", "forecast_days", "forecast_open_days_only", "promo_dates",
                                           "school_holiday_dates").limit(1)
    both = req.unionByName(req.withColumn("Store", F.lit(12345)))
    got = {r.Store: r.days for r in fc.build_forecasts(snap, both).collect()}
    assert len(got) == 2 and got[12345] is None


def test_store_numbers_beyond_32_bits_of_ids(spark):
    snap = _snapshot(spark).withColumn("Store", F.col("Store") + 300_000_000)
    assert rq.request_variants(snap).agg(F.min("request_id")).first()[0] > 30_000_000_000 - 1
    assert rq.scenario_requests(snap).agg(F.min("request_id")).first()[0] > 300_000_000_000 - 1
    assert rq.plan_requests(snap).count() > 0
