"""The feature snapshot of every store, kept up to date from new fact files.

``transformWithState`` holds one small state per store: the number of open days seen, the day of the last
promotion, whether a Sunday was open, the bounds of the target, and the last days that rolling features and
the calendar lag look at. A new file of daily rows moves the state on; nothing older is read again. After
any number of increments the snapshot equals ``forecast.history_state`` over all their rows, as long as each store's
days arrive in order. A day not after the store's last one is counted in ``late`` and changes nothing, so a
file that is processed again after a failure does no harm.

The intake reads the newest snapshot with each micro-batch (``latest``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..params import PROMO_SENTINEL
from ..session import scratch_path

#: Rows before a day that its features need, rows of the tail, rows of the tail's mean.
WARM, LONG, SHORT, TAIL, MEAN = 14, 14, 7, 8, 7
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FACTS = T.StructType([T.StructField("Store", T.IntegerType()), T.StructField("Date", T.DateType()), T.StructField("DayOfWeek", T.IntegerType()),
                      T.StructField("Sales", T.LongType()), T.StructField("Promo", T.IntegerType())])
SNAPSHOT = ("Store int, latest_date date, last_rolling_7_sales double, last_rolling_14_sales double, last_rolling_7_std_sales double, "
            "last_days_since_promo int, last_sales double, tail7_mean double, closes_on_sundays boolean, "
            "tail_dates array<string>, tail_sales array<double>, lo double, hi double, n_days bigint, late bigint")


def fresh() -> dict:
    return {"n": 0, "promo": 0, "sunday": False, "lo": None, "hi": None, "days": [], "late": 0}


def advance(state: dict, date: str, weekday: int, sales: float, promo: int) -> None:
    """One day more. ``days`` keeps the last LONG + 1 (date, sales)."""
    if state["days"] and date <= state["days"][-1][0]:
        state["late"] += 1
        return
    state["n"] += 1
    if promo == 1:
        state["promo"] = state["n"]
    if state["n"] > WARM:
        state["sunday"] = state["sunday"] or weekday == 7
        state["lo"] = sales if state["lo"] is None else min(state["lo"], sales)
        state["hi"] = sales if state["hi"] is None else max(state["hi"], sales)
    state["days"] = [*state["days"], [date, sales]][-(LONG + 1):]


def snapshot_of(state: dict) -> tuple | None:
    """The snapshot's columns after the store, None while no day has all its features."""
    if state["n"] <= WARM:
        return None
    before = [s for _, s in state["days"][:-1]]
    seven = before[-SHORT:]
    mean = sum(seven) / SHORT
    std = (sum((x - mean) ** 2 for x in seven) / (SHORT - 1)) ** 0.5
    kept = state["days"][-min(state["n"] - WARM, TAIL):]          # days that have all their features
    last = [s for _, s in kept[-MEAN:]]
    since = state["n"] - state["promo"] if state["promo"] else PROMO_SENTINEL + state["n"]
    return (state["days"][-1][0], mean, sum(before[-LONG:]) / LONG, std, since, state["days"][-1][1], sum(last) / len(last),
            not state["sunday"], [d for d, _ in kept], [s for _, s in kept], state["lo"], state["hi"], state["n"], state["late"])


class SnapshotProcessor(StatefulProcessor):
    """One state per store, as JSON text of ``fresh``'s fields."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("snapshot", "doc string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import datetime as dt

        import pandas as pd
        state = json.loads(self.kept.get()[0]) if self.kept.exists() else fresh()
        days = pd.concat(list(rows)).sort_values("Date", kind="stable")
        for date, weekday, sales, promo in zip(days["Date"], days["DayOfWeek"], days["Sales"], days["Promo"]):
            advance(state, str(date)[:10], int(weekday), float(sales), int(promo))
        self.kept.update((json.dumps(state),))
        out = snapshot_of(state)
        if out is not None:
            names = [f.split()[0] for f in SNAPSHOT.split(", ")]
            row = dict(zip(names, (key[0], dt.date.fromisoformat(out[0]), *out[1:])))
            yield pd.DataFrame([row], columns=names)

    def close(self) -> None:
        pass


def update(spark: SparkSession, facts: str, target: str, checkpoint: str) -> str:
    """Drain all new fact files (Parquet, columns of ``FACTS``) and add the snapshots of the stores they hold
    under ``target``, one folder per micro-batch, written anew if the batch is repeated."""
    from ..operators.workers import ship
    ship(spark)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        stream = spark.readStream.schema(FACTS).parquet(facts)
        q = (stream.groupBy("Store")
             .transformWithStateInPandas(SnapshotProcessor(), outputStructType=SNAPSHOT, outputMode="Update", timeMode="None")
             .writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{target}/batch={k}")).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return target


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest snapshot of every store, in the form of ``forecast.history_state``."""
    every = spark.read.schema(SNAPSHOT + ", batch bigint").parquet(target)
    newest = Window.partitionBy("Store").orderBy(F.desc("batch"))
    s = every.withColumn("_r", F.row_number().over(newest)).filter("_r = 1")
    tail = F.zip_with("tail_dates", "tail_sales", lambda d, x: F.struct(d.cast("date").alias("d"), x.alias("s")))
    return s.select("Store", "latest_date", "last_rolling_7_sales", "last_rolling_14_sales", "last_rolling_7_std_sales",
                    "last_days_since_promo", "last_sales", "tail7_mean", "closes_on_sundays", tail.alias("tail"))


def run(spark: SparkSession, increments: list[DataFrame], target: str | None = None, checkpoint: str | None = None) -> str:
    """Each increment as a new file, drained by a query of its own on the same checkpoint."""
    facts, target = scratch_path(spark, "snapshot_facts"), target or scratch_path(spark, "snapshot")
    checkpoint = checkpoint or scratch_path(spark, "snapshot_checkpoint")
    for k, df in enumerate(increments):
        df.select(*[F.col(f.name).cast(f.dataType) for f in FACTS]).write.mode("append").parquet(facts)
        update(spark, facts, target, checkpoint)
    return target
