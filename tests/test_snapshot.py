"""The streamed feature snapshot against the state recomputed from all rows."""

from paths import SF_SMALL
from pyspark.sql import functions as F

from tidecast.operators import clean, features
from tidecast.operators import forecast as fc
from tidecast.plans import tables
from tidecast.session import scratch_path
from tidecast.sources import panel
from tidecast.streaming import snapshot


def _state(days):
    """(per store) the state recomputed from daily rows."""
    return fc.history_state(features.engineer_features(clean.add_calendar(days)))


def _rows(df):
    num = lambda v: round(v, 6) if isinstance(v, float) else v
    cols = ["Store", "latest_date", "last_rolling_7_sales", "last_rolling_14_sales", "last_rolling_7_std_sales", "last_days_since_promo",
            "last_sales", "tail7_mean", "closes_on_sundays", "tail"]
    return {r.Store: tuple([(t["d"], t["s"]) for t in sorted(r.tail)] if c == "tail" else num(r[c]) for c in cols) for r in df.select(*cols).collect()}


def test_every_increment_equals_the_recomputed_state(spark):
    days = tables.open_days(panel.sales_daily(spark, SF_SMALL)).filter("Store < 6").cache()
    at = sorted(r.Date for r in days.select("Date").distinct().collect())
    cuts = [at[9], at[40], at[41], at[-1]]                         # too few days at first, one day alone
    facts, target, checkpoint = (scratch_path(spark, n) for n in ("facts", "snap", "ckpt"))
    low = None
    for k, high in enumerate(cuts):
        part = days.filter(F.col("Date") <= F.lit(high)) if low is None else days.filter((F.col("Date") > F.lit(low)) & (F.col("Date") <= F.lit(high)))
        part.select(*[F.col(f.name).cast(f.dataType) for f in snapshot.FACTS]).write.mode("append").parquet(facts)
        snapshot.update(spark, facts, target, checkpoint)
        low = high
        if k:
            assert _rows(snapshot.latest(spark, target)) == _rows(_state(days.filter(F.col("Date") <= F.lit(high))))
    # the same days again: nothing changes, they are counted as late
    before = _rows(snapshot.latest(spark, target))
    days.filter(F.col("Date") > F.lit(cuts[1])).select(*[F.col(f.name).cast(f.dataType) for f in snapshot.FACTS]).write.mode("append").parquet(facts)
    snapshot.update(spark, facts, target, checkpoint)
    assert _rows(snapshot.latest(spark, target)) == before
    again = spark.read.schema(snapshot.SNAPSHOT + ", batch bigint").parquet(target)
    assert again.agg(F.max("late")).first()[0] > 0
    days.unpersist()


def test_state_of_one_store_by_hand():
    s = snapshot.fresh()
    for k in range(14):
        snapshot.advance(s, f"2024-01-{k + 1:02d}", 1, float(k), 0)
        assert snapshot.snapshot_of(s) is None
    snapshot.advance(s, "2024-01-15", 7, 100.0, 1)
    out = snapshot.snapshot_of(s)
    assert out[0] == "2024-01-15" and out[1] == 10.0 and out[2] == 6.5 and out[4] == 0 and out[6] == 100.0 and out[7] is False
    snapshot.advance(s, "2024-01-15", 7, 5.0, 0)
    assert s["late"] == 1 and snapshot.snapshot_of(s)[:12] == out[:12]
    snapshot.advance(s, "2024-02-01", 2, 1.0, 0)
    assert snapshot.snapshot_of(s)[4] == 1 and snapshot.snapshot_of(s)[8] == ["2024-01-15", "2024-02-01"]
