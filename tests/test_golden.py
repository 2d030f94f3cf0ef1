"""Numbers computed by hand (plain Python over small series written here)."""

import math

import pytest
from pyspark.sql import functions as F

from tidecast.operators import decisions as dc
from tidecast.operators import evaluate as ev
from tidecast.operators import features as fe
from tidecast.operators import forecast as fc
from tidecast.operators import windows
from tidecast.params import LinearPlan, WindowParams

UNITS = [20 + 3 * (i % 7) + i // 10 for i in range(60)]


@pytest.fixture()
def series(spark):
    rows = [("p", i, u, 2.0 + i % 3, 100 - i % 5, int(i % 9 == 0), i % 7, 1 + i // 30) for i, u in enumerate(UNITS)]
    df = spark.createDataFrame(rows, "product string, i int, units_sold long, price double, stock long, promotion int, "
                                     "day_of_week int, month int")
    return df.withColumn("date", F.date_add(F.lit("2023-01-01").cast("date"), F.col("i"))).drop("i")


def _naive(values, lookback=30, horizon=7, share=0.8, method=lambda v, t, d: v[t - d]):
    """(errors of the test windows, windows, test windows) by plain loops."""
    n = len(values) - lookback - horizon + 1
    first = math.floor(n * share)
    errors = []
    for s in range(first, n):
        for d in range(1, horizon + 1):
            t = s + lookback - 1 + d
            errors.append((values[t], method(values, t, d)))
    return errors, n, n - first


def _metrics(errors):
    mae = sum(abs(a - p) for a, p in errors) / len(errors)
    rmse = math.sqrt(sum((a - p) ** 2 for a, p in errors) / len(errors))
    mape = sum(abs(a - p) / (abs(a) + 1e-8) for a, p in errors) / len(errors) * 100
    return mae, rmse, mape, len(errors)


def test_windows_and_naive_baselines(series):
    df = windows.with_positions(series, "product", "date")
    idx = windows.window_index(df, key="product", order="date")
    last, n, n_test = _naive(UNITS)
    weekly, _, _ = _naive(UNITS, method=lambda v, t, d: v[t - 7])
    assert (idx.count(), idx.filter("split = 'test'").count()) == (n, n_test) == (24, 5)
    h = windows.horizon_rows(df, key="product", order="date", target="units_sold")
    for col, errors in (("last_value", last), ("weekly_seasonal", weekly)):
        got = ev.error_metrics(ev.prediction_records(h, col, policy="epsilon", key="product"), [], policy="epsilon").first()
        assert (got.mae, got.rmse, got.mape, got.n_points) == pytest.approx(_metrics(errors), abs=1e-9)


def test_weekly_baseline_beyond_seven_days_never_reads_ahead_of_the_anchor(series):
    df = windows.with_positions(series, "product", "date")
    h = windows.horizon_rows(df, WindowParams(horizon=10), key="product", order="date", target="units_sold")
    got = {(r.sample_index, r.forecast_day): r.weekly_seasonal for r in h.collect()}
    for (s, d), v in got.items():
        anchor = s + 29
        assert v == UNITS[anchor + d - 7 * math.ceil(d / 7)]


def test_lag7_baseline_after_null_drop(series):
    h = windows.horizon_rows(fe.synthetic_features(series), key="product", order="date", target="units_sold")
    p = ev.prediction_records(h, "weekly_seasonal", policy="epsilon", key="product")
    errors, _, n_test = _naive(UNITS[7:], method=lambda v, t, d: v[t - 7])
    assert p.select("sample_index").distinct().count() == n_test
    assert ev.error_metrics(p, [], policy="epsilon").first().mae == pytest.approx(_metrics(errors)[0], abs=1e-9)


def test_wide_predictions_unpivot_metrics(spark):
    actual = [[100.0 + 10 * d + s for d in range(7)] for s in range(3)]
    pred = [[a + (-1) ** d * (d + 1) for d, a in enumerate(row)] for row in actual]
    cols = ", ".join(f"Day_{d}_Actual double, Day_{d}_Pred double" for d in range(1, 8))
    wide = spark.createDataFrame([(1, s, *[x for p in zip(actual[s], pred[s]) for x in p]) for s in range(3)],
                                 f"Store int, Sample_Index int, {cols}")
    long = ev.unpivot_predictions(wide, key=("Store", "Sample_Index"))
    long = long.withColumn("absolute_error", F.abs(F.col("actual_sales") - F.col("predicted_sales")))
    assert long.count() == 21
    by_day = {r.forecast_day: r.mae for r in ev.error_metrics(long, ["forecast_day"]).collect()}
    assert [by_day[d] for d in range(1, 8)] == pytest.approx([1, 2, 3, 4, 5, 6, 7])
    assert ev.error_metrics(long, [], policy="raw").first().mae == pytest.approx(4.0)


def test_insight_rules_case(spark):
    df = spark.createDataFrame([(26076, 7, 18000, 12.5, 3, 0.15)],
                               "total long, n int, stock long, price double, lead int, safety double")
    cols = dc.insight_columns(*[F.col(c) for c in ("total", "n", "stock", "price", "lead", "safety")])
    r = df.select(*[c.alias(k) for k, c in cols.items()]).first()
    assert (r.average_predicted_sales, r.expected_revenue, r.projected_stock_after_7_days) == (3725, 325950.0, -8076)
    assert (r.stockout_risk, r.recommended_reorder_quantity, r.reorder_needed) == ("high", 11987, True)


def test_future_dates_skip_sundays(spark):
    df = spark.createDataFrame([("2015-07-31",)], "d string").select(F.to_date("d").alias("d"))
    got = df.select(fc.future_dates(F.col("d"), F.lit(7), F.lit(True), F.lit(True)).alias("x")).first().x
    assert [str(x) for x in got] == ["2015-08-01", "2015-08-03", "2015-08-04", "2015-08-05", "2015-08-06",
                                     "2015-08-07", "2015-08-08"]
    cal = df.select(fc.future_dates(F.col("d"), F.lit(7), F.lit(False), F.lit(True)).alias("x")).first().x
    assert str(cal[1]) == "2015-08-02"


def test_linear_plan_by_hand(spark):
    df = spark.createDataFrame([(100.0, 80.0, 0, 0, 0), (100.0, 80.0, 1, 0, 0), (100.0, 80.0, 1, 1, 1), (-500.0, 10.0, 0, 0, 0)],
                               "lag double, roll double, promo int, school int, weekend int")
    got = [r.x for r in df.select(fc.planned_sales(*[F.col(c) for c in ("lag", "roll", "promo", "school", "weekend")],
                                                   LinearPlan()).alias("x")).collect()]
    assert got == pytest.approx([92.0, 112.0, 108.0, 0.0])
