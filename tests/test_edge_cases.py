"""Degenerate panels: short stores, no promo ever, constant sales, train-only
scaler scope (no leakage from test rows)."""

import datetime as dt

from pyspark.sql import functions as F

from tidecast.operators import features as fe
from tidecast.operators import scaling, windows
from tidecast.params import WindowParams


def _panel(spark, spec):
    """spec: {store: (n_rows, sales_fn, promo_fn)} -> minimal processed table."""
    rows = []
    start = dt.date(2020, 1, 6)
    for store, (n, sales, promo) in spec.items():
        for i in range(n):
            d = start + dt.timedelta(days=i)
            dow = d.isoweekday()
            rows.append((store, d, int(sales(i)), int(promo(i)), 0, int(dow in (6, 7)), d.month, dow))
    return spark.createDataFrame(rows, "Store int, Date date, Sales long, Promo int, SchoolHoliday int, "
                                       "IsWeekend int, Month int, DayOfWeek int")


def test_short_store_has_no_windows_and_no_error(spark):
    p = _panel(spark, {1: (50, lambda i: 10 + i % 5, lambda i: 0),    # 50 - 14 = 36 rows -> 0 windows
                       2: (51, lambda i: 10 + i % 5, lambda i: 0),    # 37 rows -> 1 window
                       3: (10, lambda i: 5, lambda i: 1)})            # all rows dropped by the lag filter
    feat = fe.engineer_features(p)
    idx = {r.Store: r.c for r in windows.window_index(feat).groupBy("Store").count()
           .withColumnRenamed("count", "c").collect()}
    assert idx.get(1, 0) == 0 and idx.get(2, 0) == 1 and 3 not in idx
    h = windows.horizon_rows(feat)
    assert h.filter("Store = 2").count() == 7
    assert h.filter("Store <> 2").count() == 0


def test_never_promo_uses_sentinel(spark):
    p = _panel(spark, {7: (40, lambda i: 3, lambda i: 0)})
    f = fe.engineer_features(p, drop_incomplete=False).orderBy("Date").collect()
    assert f[0].days_since_last_promo == 10000 and f[-1].days_since_last_promo == 10039
    assert f[0].days_until_next_promo == 10039 and f[-1].days_until_next_promo == 10000


def test_constant_feature_scales_to_zero(spark):
    p = _panel(spark, {4: (60, lambda i: 42, lambda i: i % 2)})
    feat = fe.engineer_features(p)
    out = scaling.minmax_over_partition(feat, ["Sales", "rolling_7_std_sales"])
    vals = {r.Sales_scaled for r in out.collect()} | {r.rolling_7_std_sales_scaled for r in out.collect()}
    assert vals == {0.0}


def test_train_scope_scaler_ignores_test_rows(spark):
    p = _panel(spark, {5: (120, lambda i: i, lambda i: 0)})   # increasing sales: test rows hold the max
    feat = fe.engineer_features(p)
    wp = WindowParams()
    n = feat.count()
    train_size = int((n - 36) * wp.train_fraction)
    last_train_row = train_size - 1 + wp.lookback + wp.horizon - 1
    scope = F.col("row_position") <= last_train_row
    all_fit = scaling.fit_minmax(feat, ["Sales"]).first()
    train_fit = scaling.fit_minmax(feat, ["Sales"], scope=scope).first()
    assert train_fit["max"] < all_fit["max"]
    assert train_fit["max"] == feat.filter(scope).agg(F.max("Sales")).first()[0]
