"""Continuous request intake (re-aim of the request/response service).

    JSON lines --readStream--> parse + validate --+--> rejected sink (text kept)
                                                  +--> defaults -> join the
        feature snapshot (stream-static) -> forecast -> insights -> history

Requests are read as text, so a mistyped field or a broken line is rejected with
its text and never read as absent. A valid request for a store without history
is rejected with error ``Store``. Stateless per micro-batch: each batch id has its
own folder in both sinks and is overwritten when the batch is processed again,
so a replay after a failure leaves every request once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions as dc
from ..operators import forecast as fc
from ..operators import history as hs
from ..operators import validate as vd
from ..session import scratch_path

#: Envelope fields beside the request: id, store and time of submission.
ENVELOPE = {"request_id": "bigint", "Store": "int", "submitted_at": "string"}
REJECTED = ["request_id", "Store", "body", "errors"]


def parse_lines(lines: DataFrame) -> DataFrame:
    """Request columns, envelope and errors of JSON lines (column ``body``)."""
    v = F.try_parse_json("body")
    v = F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    env = lines.select("*", *[F.try_variant_get(v, f"$.{c}", t).alias(c) for c, t in ENVELOPE.items()])
    env = env.withColumn("submitted_at", F.col("submitted_at").try_cast("timestamp_ntz"))
    r = vd.validate_requests(vd.parse_requests(env))
    absent = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ENVELOPE])
    absent = F.when(F.array_contains("errors", "body"), F.array().cast("array<string>")) \
        .otherwise(F.filter(absent, lambda x: x.isNotNull()))
    return r.withColumn("errors", F.concat(absent, "errors")).withColumn("is_valid", F.size("errors") == 0)


def split_requests(lines: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted requests joined to their store's state, rejected requests)."""
    v = parse_lines(lines).withColumnRenamed("Store", "_store")
    j = v.join(snapshot, v["_store"] == snapshot["Store"], "left")
    known = F.col("Store").isNotNull()
    bad = j.filter(~F.col("is_valid") | ~known).select(
        "request_id", F.col("_store").alias("Store"), "body",
        F.when(F.col("is_valid"), F.array(F.lit("Store"))).otherwise(F.col("errors")).alias("errors"))
    return j.filter(F.col("is_valid") & known).drop("_store"), bad


def process_batch(batch: DataFrame, batch_id: int, snapshot: DataFrame | Callable[[], DataFrame], history_path: str,
                  rejected_path: str) -> None:
    ok, bad = split_requests(batch, snapshot() if callable(snapshot) else snapshot)
    bad.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
    f = dc.with_insights(fc.forecast_joined(vd.request_defaults(ok)))
    f = f.withColumn("response_average", (F.col("total_predicted_sales") / F.size("days")).cast("bigint"))
    hs.log_write(hs.log_rows(f, created_at="submitted_at"), f"{history_path}/batch={batch_id}", "overwrite")


def run_intake(spark: SparkSession, inbox: str, snapshot: DataFrame | Callable[[], DataFrame], history_path: str | None = None,
               rejected_path: str | None = None, checkpoint: str | None = None,
               max_files_per_trigger: int = 100) -> dict:
    """Drain every request file currently in ``inbox`` (availableNow, in
    micro-batches of at most ``max_files_per_trigger`` files) and stop. ``snapshot``: the state of every
    store, or a function that reads the newest one for each micro-batch (``snapshot.latest``)."""
    history_path = history_path or scratch_path(spark, "intake_history")
    rejected_path = rejected_path or scratch_path(spark, "intake_rejected")
    checkpoint = checkpoint or scratch_path(spark, "intake_checkpoint")
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(inbox) \
        .select(F.col("value").alias("body")).filter(F.trim("body") != "")
    q = (lines.writeStream
         .foreachBatch(lambda b, batch_id: process_batch(b, batch_id, snapshot, history_path, rejected_path))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return {"history": history_path, "rejected": rejected_path, "checkpoint": checkpoint}
