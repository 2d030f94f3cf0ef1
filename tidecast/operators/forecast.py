"""Forecast construction for every (store, request) at once.

Plan shape: the engineered history is aggregated per store into a small
``latest_state`` row (rolling values, promo counter, tail-7 mean and the last
8 (Date, Sales) pairs — the only rows a calendar lag-7 can hit). Requests are
joined to that state once; the future calendar, promo counters, lag lookup,
predictions, totals and peak/trough are then computed per (store, request)
row with array higher-order functions — no further shuffle. ``inline``
turns the result into day rows only where a consumer needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.metrics import demand_level
from ..params import FUTURE_PROMO_CAP, DemandThresholds, LinearPlan
from .windows import latest_state

NAIVE = ("WeeklySeasonalNaive", "v1")


def history_state(feat: DataFrame, key: str = "Store", extra_aggs: list[Column] | None = None) -> DataFrame:
    """``windows.latest_state`` with the tail (Date, Sales) array for the
    calendar lag (``extra_aggs``: e.g. scaler fits, in the same aggregation)."""
    return latest_state(feat, key, with_tail=True, extra_aggs=extra_aggs)


def future_dates(latest: Column, horizon: Column, open_only: Column, closes_on_sundays: Column) -> Column:
    """The next ``horizon`` dates after ``latest``; Sundays skipped when the
    request is in open-days mode AND the store has no Sunday in its history."""
    skip = open_only & closes_on_sundays
    cand = F.sequence(F.date_add(latest, 1), F.date_add(latest, horizon * 2 + 1))
    kept = F.filter(cand, lambda d: ~(skip & (F.weekday(d) == 6)))
    return F.slice(kept, 1, horizon)


def _since_promo(flags: Column, start: Column, cap: int) -> Column:
    """Counter continuing from the history, reset to 0 on a planned promo, capped."""
    def at(_x, i):
        last_p = F.array_max(F.filter(F.sequence(F.lit(0), i), lambda k: F.element_at(flags, k + 1)))
        return F.when(F.element_at(flags, i + 1), F.lit(0)).when(
            last_p.isNotNull(), F.least(F.lit(cap), i - last_p)).otherwise(
            F.least(F.lit(cap), start + i + 1))
    return F.transform(flags, at)


def _until_promo(flags: Column, cap: int) -> Column:
    """Backwards within the horizon; no promo ahead -> cap."""
    def at(_x, i):
        nxt = F.array_min(F.filter(F.sequence(i, F.size(flags) - 1), lambda k: F.element_at(flags, k + 1)))
        return F.when(nxt.isNotNull(), F.least(F.lit(cap), nxt - i)).otherwise(F.lit(cap))
    return F.transform(flags, at)


def planned_sales(lag7: Column, rolling7: Column, promo: Column, school: Column, weekend: Column,
                  plan: LinearPlan) -> Column:
    """The linear model on one future day, never negative."""
    raw = (lag7 * F.lit(plan.lag) + rolling7 * F.lit(plan.rolling) + rolling7 * F.lit(plan.promo) * promo
           + rolling7 * F.lit(plan.school_holiday) * school + rolling7 * F.lit(plan.promo_weekend) * promo * weekend)
    return F.greatest(raw, F.lit(0.0))


def build_forecasts(state: DataFrame, requests: DataFrame, th: DemandThresholds = DemandThresholds(),
                    cap: int = FUTURE_PROMO_CAP, plan: LinearPlan | None = LinearPlan()) -> DataFrame:
    """One row per (Store, request): ``days`` (array of day structs with the
    known-future features and the prediction) and the response summary fields.
    ``requests`` needs Store, request_id and the request fields (promo_dates /
    school_holiday_dates as ARRAY<DATE>). A request for a store without history
    stays in the result: its ``latest_date``, ``days`` and totals are null."""
    return forecast_joined(requests.join(state, "Store", "left"), th, cap, plan)


def forecast_joined(j: DataFrame, th: DemandThresholds = DemandThresholds(), cap: int = FUTURE_PROMO_CAP,
                    plan: LinearPlan | None = LinearPlan()) -> DataFrame:
    """``build_forecasts`` on rows that already carry state + request fields.
    ``plan``: the linear model; None: the weekly-seasonal naive value."""
    model_name, model_version = (plan.name, plan.version) if plan else NAIVE
    h = F.coalesce(F.col("forecast_days"), F.lit(7))
    dates = future_dates(F.col("latest_date"), h, F.col("forecast_open_days_only"), F.col("closes_on_sundays"))
    promo_dates = F.coalesce(F.col("promo_dates"), F.array().cast("array<date>"))
    school_dates = F.coalesce(F.col("school_holiday_dates"), F.array().cast("array<date>"))
    j = j.withColumn("_dates", dates)
    flags = F.transform(F.col("_dates"), lambda d: F.array_contains(promo_dates, d))
    j = j.withColumn("_since", _since_promo(flags, F.col("last_days_since_promo"), cap)) \
         .withColumn("_until", _until_promo(flags, cap))

    def day(d, i):
        dow = cal.iso_day_of_week(d)
        wkend = cal.is_weekend(dow)
        promo = F.array_contains(promo_dates, d).cast("int")
        school = F.array_contains(school_dates, d).cast("int")
        open_ = F.when(F.col("closes_on_sundays") & (dow == 7), 0).otherwise(1)
        hit = F.filter(F.col("tail"), lambda t: t["d"] == F.date_sub(d, 7))
        lag7 = F.coalesce(F.try_element_at(hit, F.lit(1))["s"], F.col("tail7_mean"))
        value = planned_sales(lag7, F.col("last_rolling_7_sales"), promo, school, wkend, plan) if plan else lag7
        raw = F.when(open_ == 0, F.lit(0.0)).otherwise(value)
        pred = F.bround(raw, 0).cast("bigint")
        month = F.month(d)
        return F.struct(
            (i + 1).alias("step"), d.alias("date"), dow.alias("day_of_week"),
            cal.weekday_label(dow).alias("weekday"), wkend.alias("is_weekend"),
            promo.alias("promo"), school.alias("school_holiday"), open_.alias("open"),
            month.alias("month"), F.dayofmonth(d).alias("day"),
            cal.is_month_start(d).alias("is_month_start"), cal.is_month_end(d).alias("is_month_end"),
            cal.is_april(month).alias("is_april"),
            (promo * school).alias("promo_schoolholiday"), (wkend * school).alias("weekend_schoolholiday"),
            (promo * wkend).alias("promo_weekend"),
            lag7.alias("lag_7_sales"),
            F.col("last_rolling_7_sales").alias("rolling_7_sales"),
            F.col("last_rolling_14_sales").alias("rolling_14_sales"),
            F.col("last_rolling_7_std_sales").alias("rolling_7_std_sales"),
            F.element_at(F.col("_since"), i + 1).alias("days_since_last_promo"),
            F.element_at(F.col("_until"), i + 1).alias("days_until_next_promo"),
            raw.alias("raw_prediction"), pred.alias("predicted_sales"),
            demand_level(pred, th).alias("demand_level"))

    days = F.transform(F.col("_dates"), day)
    out = j.withColumn("days", days).drop("_dates", "_since", "_until", "tail")
    preds = F.transform(F.col("days"), lambda x: x["predicted_sales"])
    total = F.aggregate(preds, F.lit(0).cast("bigint"), lambda a, x: a + x)
    n = F.size(F.col("days"))

    def first_by(better):
        init = F.try_element_at(F.col("days"), F.lit(1))
        return F.aggregate(F.col("days"), init, lambda acc, x: F.when(
            better(x["predicted_sales"], acc["predicted_sales"]), x).otherwise(acc))["date"]

    return out.select(
        "*",
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        F.when(F.coalesce(F.col("forecast_open_days_only"), F.lit(True)), "open days only")
         .otherwise("calendar days").alias("forecast_mode"),
        total.alias("total_predicted_sales"),
        F.when(n > 0, (total / n).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("average_predicted_sales"),
        first_by(lambda x, a: x > a).alias("highest_demand_day"),
        first_by(lambda x, a: x < a).alias("lowest_demand_day"),
    )


def forecast_rows(fc: DataFrame, keys: tuple[str, ...] = ("Store", "request_id")) -> DataFrame:
    """One row per forecast day (narrow ``inline``)."""
    return fc.select(*keys, F.inline("days"))


def forecast_with_model(fc: DataFrame, model, keys: tuple[str, ...] = ("Store", "request_id")) -> DataFrame:
    """Score every future day of every (store, request) with a fitted Spark ML
    pipeline (trained on ``models.training_rows``): last value = last history
    Sales, weekly-seasonal = the calendar lag-7 value, plus the day's
    known-ahead features. Closed days stay 0; predictions are rounded half
    to even. Returns day rows (narrow inline + JVM transform, no shuffle)."""
    from . import models as md
    rows = fc.select(*keys, "last_sales", F.inline("days"))
    # day-struct names -> model feature names (Spark names are case-insensitive,
    # so the renamed originals are not carried along)
    source = {"last_value": "last_sales", "weekly_seasonal": "lag_7_sales", "forecast_day": "step",
              "Promo": "promo", "SchoolHoliday": "school_holiday", "DayOfWeek": "day_of_week",
              "IsWeekend": "is_weekend", "Month": "month"}
    feats = rows.select(*keys, "step", "date", "open",
                        *[F.col(source.get(c, c)).cast("double").alias(c) for c in md.MODEL_FEATURES
                          if c != "forecast_day"],
                        F.col("step").cast("double").alias("forecast_day"))
    scored = model.transform(feats)
    raw = F.when(F.col("open") == 0, F.lit(0.0)).otherwise(F.greatest(F.col("prediction"), F.lit(0.0)))
    return scored.select(*keys, "step", "date", "open", F.col("Promo").cast("int").alias("promo"),
                         raw.alias("model_raw_prediction"), F.bround(raw, 0).cast("bigint").alias("model_predicted_sales"))
