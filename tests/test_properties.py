"""Property checks: promo counters equal plain row loops, windows
never cross a store, window counts are max(0, n - 36), no past feature reads
a later row."""

import random

from pyspark.sql import functions as F

from paths import SF_SMALL
from tidecast.operators import features as fe
from tidecast.operators import windows
from tidecast.plans import tables


def _loop_counters(promos, sentinel=9999):
    since, c = [], sentinel
    for p in promos:
        c = 0 if p == 1 else c + 1
        since.append(c)
    until, c = [], sentinel
    for p in reversed(promos):
        c = 0 if p == 1 else c + 1
        until.append(c)
    return since, until[::-1]


def test_promo_counters_match_loops(spark):
    rnd = random.Random(7)
    rows, expect = [], {}
    for store in range(40):
        n = rnd.randint(1, 60)
        density = rnd.choice([0.0, 0.05, 0.3, 0.9, 1.0])
        promos = [1 if rnd.random() < density else 0 for _ in range(n)]
        s, u = _loop_counters(promos)
        for i, p in enumerate(promos):
            rows.append((store, i, p))
            expect[(store, i)] = (s[i], u[i])
    df = spark.createDataFrame(rows, "Store int, Date int, Promo int")
    got = {(r.Store, r.Date): (r.days_since_last_promo, r.days_until_next_promo)
           for r in fe.promo_counters(df).collect()}
    assert got == expect


def test_windows_count_and_store_bounds(spark):
    feat = tables.feature_table(spark, SF_SMALL)
    n = {r.Store: r.n for r in feat.groupBy("Store").agg(F.count(F.lit(1)).alias("n")).collect()}
    idx = windows.window_index(feat)
    got = {r.Store: r.c for r in idx.groupBy("Store").agg(F.count(F.lit(1)).alias("c")).collect()}
    for store, rows in n.items():
        assert got.get(store, 0) == max(0, rows - 36)
    h = windows.horizon_rows(feat)
    bad = h.filter((F.col("target_row") - F.col("forecast_day") - 29 != F.col("sample_index"))).count()
    assert bad == 0


def test_no_past_feature_reads_a_later_row(spark):
    allp = tables.processed(spark, SF_SMALL)
    store = allp.agg(F.min("Store")).first()[0]     # store 1 is absent at sf0.001
    proc = allp.filter(F.col("Store") == store)
    dates = sorted(r.Date for r in proc.select("Date").collect())
    cut = dates[len(dates) // 2]
    base = fe.engineer_features(proc)
    bumped = fe.engineer_features(proc.withColumn(
        "Sales", F.when(F.col("Date") > cut, F.col("Sales") * 10 + 7).otherwise(F.col("Sales"))))
    cols = ["lag_7_sales", "rolling_7_sales", "rolling_14_sales", "rolling_7_std_sales", "sales_vs_lag7",
            "days_since_last_promo"]
    a = {r.Date: tuple(r[c] for c in cols) for r in base.filter(F.col("Date") <= cut).collect()}
    b = {r.Date: tuple(r[c] for c in cols) for r in bumped.filter(F.col("Date") <= cut).collect()}
    assert a == b and len(a) > 0
