"""Queries: the future frame, forecasts, responses and the
inventory decisions and scenarios (2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formatting as fmt
from ..functions.metrics import clip_unit as clip_expr
from ..functions.metrics import demand_level as level_expr
from ..functions.metrics import risk_normalise as risk_expr
from ..operators import decisions as dc
from ..operators import forecast as fc
from ..operators import history as hs
from ..operators import scaling, windows
from ..functions import scaling as scf
from ..params import FUTURE_FEATURES, PAST_FEATURES, DemandThresholds
from . import tables
from . import requests as rq
from .oracle import sql
from .registry import r4, register


def _state(spark, sf):
    feat = tables.feature_table(spark, sf)
    return feat, fc.history_state(feat)


def _default(spark, sf, open_days_only=True):
    _, st = _state(spark, sf)
    return fc.forecast_joined(rq.default_requests(st, open_days_only))


def _rows(spark, sf, open_days_only=True):
    return fc.forecast_rows(_default(spark, sf, open_days_only))


def _scen(spark, sf):
    _, st = _state(spark, sf)
    return dc.with_insights(fc.forecast_joined(rq.scenario_requests(st)))


@register("future_dates", sql("SELECT Store, step, date FROM future_dates", "future_dates"))
def future_dates(spark, sf):
    """Next 7 dates after each store's latest day (Sundays skipped for stores
    that close on Sundays, open-days mode)."""
    return _rows(spark, sf).select("Store", "step", "date")


@register("future_calendar_features", sql("""
SELECT Store, step, date, day_of_week, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(day_of_week IN (6, 7) AS INTEGER) AS is_weekend, open,
       CAST(day(date) = 1 AS INTEGER) AS is_month_start, CAST(date = last_day(date) AS INTEGER) AS is_month_end,
       CAST(month(date) = 4 AS INTEGER) AS is_april
FROM future_pred_cal""", "future_pred_cal"))
def future_calendar_features(spark, sf):
    """Calendar features of the horizon (calendar-days mode: Sundays kept, Open=0 where closed)."""
    return _rows(spark, sf, open_days_only=False).select(
        "Store", "step", "date", "day_of_week", "month", "day", "is_weekend", "open", "is_month_start",
        "is_month_end", "is_april")


@register("join_lag7_calendar", sql("""
SELECT Store, step, date, ROUND(lag_7_sales, 4) AS lag_7_sales FROM future_pred""", "future_pred"))
def join_lag7_calendar(spark, sf):
    """Sales at date - 7 calendar days, else the mean of the last 7 rows."""
    return _rows(spark, sf).select("Store", "step", "date", r4("lag_7_sales").alias("lag_7_sales"))


@register("future_lag_rolling", sql("""
SELECT Store, step, ROUND(lag_7_sales, 4) AS lag_7_sales, ROUND(last_rolling_7_sales, 4) AS rolling_7_sales,
       ROUND(last_rolling_14_sales, 4) AS rolling_14_sales, ROUND(last_rolling_7_std_sales, 4) AS rolling_7_std_sales
FROM future_pred""", "future_pred"))
def future_lag_rolling(spark, sf):
    """Calendar lag-7 plus rolling values frozen at the last historical row."""
    return _rows(spark, sf).select("Store", "step", *[r4(c).alias(c) for c in (
        "lag_7_sales", "rolling_7_sales", "rolling_14_sales", "rolling_7_std_sales")])


_PLAN_SQL = ", ".join(f"({pid}, {p if p else '[]::INTEGER[]'}, {h if h else '[]::INTEGER[]'})"
                      for pid, p, h in rq.PLANS)

_PLANNED = f"""
SELECT Store, plan, step, date, promo, school_holiday,
       CAST(CASE WHEN promo = 1 THEN 0
                 WHEN lp IS NOT NULL THEN LEAST(10, step - lp)
                 ELSE LEAST(10, last_days_since_promo + step) END AS INTEGER) AS days_since_last_promo,
       CAST(CASE WHEN promo = 1 THEN 0 WHEN np IS NOT NULL THEN LEAST(10, np - step) ELSE 10 END AS INTEGER)
         AS days_until_next_promo
FROM (SELECT *, MAX(CASE WHEN promo = 1 THEN step END) OVER (PARTITION BY Store, plan ORDER BY step
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lp,
                MIN(CASE WHEN promo = 1 THEN step END) OVER (PARTITION BY Store, plan ORDER BY step
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
      FROM (SELECT f.Store, f.step, f.date, f.last_days_since_promo, p.plan,
                   CAST(list_contains(p.promo_steps, f.step) AS INTEGER) AS promo,
                   CAST(list_contains(p.holiday_steps, f.step) AS INTEGER) AS school_holiday
            FROM future_dates f CROSS JOIN (VALUES {_PLAN_SQL}) p(plan, promo_steps, holiday_steps)))"""


def _planned(spark, sf):
    _, st = _state(spark, sf)
    return fc.forecast_rows(fc.forecast_joined(rq.plan_requests(st)), ("Store", "plan"))


@register("future_days_since_promo", sql(
    f"SELECT Store, plan, step, days_since_last_promo FROM ({_PLANNED})", "future_dates"))
def future_days_since_promo(spark, sf):
    """Counter continues from history, resets on a planned promo, capped at 10."""
    return _planned(spark, sf).select("Store", "plan", "step", "days_since_last_promo")


@register("future_days_until_promo", sql(
    f"SELECT Store, plan, step, days_until_next_promo FROM ({_PLANNED})", "future_dates"))
def future_days_until_promo(spark, sf):
    """Steps to the next planned promo inside the horizon, 10 when none."""
    return _planned(spark, sf).select("Store", "plan", "step", "days_until_next_promo")


@register("join_promo_plan", sql(f"SELECT Store, plan, step, date, promo FROM ({_PLANNED})", "future_dates"))
def join_promo_plan(spark, sf):
    """Future dates flagged when contained in the promo plan."""
    return _planned(spark, sf).select("Store", "plan", "step", "date", "promo")


@register("join_holiday_plan", sql(f"SELECT Store, plan, step, date, school_holiday FROM ({_PLANNED})",
                                   "future_dates"))
def join_holiday_plan(spark, sf):
    """Future dates flagged when contained in the school-holiday plan."""
    return _planned(spark, sf).select("Store", "plan", "step", "date", "school_holiday")


_SCALED = FUTURE_FEATURES
#: Feature -> field of a forecast day, and its SQL, where the names differ.
_RENAME = {"day_of_week": "DayOfWeek", "day": "Day", "month": "Month", "is_weekend": "IsWeekend", "promo": "Promo",
           "school_holiday": "SchoolHoliday"}
_DAY_SQL = {"DayOfWeek": "isodow(date)", "Day": "day(date)", "Month": "month(date)", "IsWeekend": "isodow(date) IN (6, 7)",
            "Promo": "pl_promo", "SchoolHoliday": "pl_school", "is_month_start": "day(date) = 1",
            "is_month_end": "date = last_day(date)", "is_april": "month(date) = 4",
            "promo_schoolholiday": "pl_promo * pl_school", "weekend_schoolholiday": "CAST(isodow(date) IN (6, 7) AS INTEGER) * pl_school",
            "promo_weekend": "pl_promo * CAST(isodow(date) IN (6, 7) AS INTEGER)", "rolling_7_sales": "last_rolling_7_sales",
            "rolling_14_sales": "last_rolling_14_sales", "rolling_7_std_sales": "last_rolling_7_std_sales"}


def _scale_sql(clip: bool) -> str:
    cols = []
    for c in _SCALED:
        src = f"CAST({_DAY_SQL[c]} AS DOUBLE)" if c in _DAY_SQL else f"CAST(f.{c} AS DOUBLE)"
        z = f"({src} - p.{c}_lo) / CASE WHEN p.{c}_hi - p.{c}_lo = 0 THEN 1.0 ELSE p.{c}_hi - p.{c}_lo END"
        if clip:
            z = f"LEAST(GREATEST({z}, 0.0), 1.0)"
        cols.append(f"ROUND({z}, 4) AS {c}_scaled")
    fit = ", ".join(f"MIN(CAST({c} AS DOUBLE)) AS {c}_lo, MAX(CAST({c} AS DOUBLE)) AS {c}_hi" for c in _SCALED)
    return f"""
SELECT f.Store, f.plan, f.step, {', '.join(cols)}
FROM (SELECT fp.*, pl.plan, pl.promo AS pl_promo, pl.school_holiday AS pl_school, pl.days_since_last_promo, pl.days_until_next_promo
      FROM future_pred fp JOIN ({_PLANNED}) pl ON fp.Store = pl.Store AND fp.step = pl.step) f
JOIN (SELECT Store, {fit} FROM features GROUP BY Store) p ON f.Store = p.Store"""


def _future_scaled(spark, sf, clip):
    """Future rows scaled with per-store min/max of the history, fitted IN the
    state aggregation (one pass over the features, no params join)."""
    feat = tables.feature_table(spark, sf)
    fit = [a for c in _SCALED for a in (F.min(F.col(c).cast("double")).alias(f"{c}_lo"),
                                        F.max(F.col(c).cast("double")).alias(f"{c}_hi"))]
    st = fc.history_state(feat, extra_aggs=fit)
    f = fc.forecast_joined(rq.plan_requests(st))
    rows = f.select("Store", "plan", *[F.col(f"{c}_lo") for c in _SCALED], *[F.col(f"{c}_hi") for c in _SCALED],
                    F.inline("days"))
    source = {v: k for k, v in _RENAME.items()}   # feature name -> day-struct field
    out = []
    for c in _SCALED:
        z = scf.minmax_transform(F.col(source.get(c, c)).cast("double"), F.col(f"{c}_lo"), F.col(f"{c}_hi"))
        out.append(r4(clip_expr(z) if clip else z).alias(c + "_scaled"))
    return rows.select("Store", "plan", "step", *out)


_PAST_ONLY = [c for c in PAST_FEATURES if c not in FUTURE_FEATURES]


def _past_sql() -> str:
    def z(c):
        x = f"CAST({c} AS DOUBLE)"
        return (f"ROUND(LEAST(GREATEST(({x} - MIN({x}) OVER s) / CASE WHEN MAX({x}) OVER s = MIN({x}) OVER s THEN 1.0 "
                f"ELSE MAX({x}) OVER s - MIN({x}) OVER s END, 0.0), 1.0), 4) AS {c}_scaled")
    cols = [z(c) for c in [*FUTURE_FEATURES, *_PAST_ONLY]]
    return f"""
SELECT * EXCLUDE (back) FROM (SELECT Store, 'past' AS stream, -1 AS plan, CAST(row_position - n_rows + 1 AS INTEGER) AS step, {', '.join(cols)},
       n_rows - row_position AS back FROM features WINDOW s AS (PARTITION BY Store)) WHERE back <= 30"""


@register("scale_future", sql("SELECT Store, 'future' AS stream, plan, step, "
                              + ", ".join(f"{c}_scaled" for c in FUTURE_FEATURES)
                              + ", " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}_scaled" for c in _PAST_ONLY)
                              + f" FROM ({_scale_sql(True)}) UNION ALL {_past_sql()}", "future_pred", "future_dates", "features"))
def scale_future(spark, sf):
    """Both input streams of the service, scaled with the history's per-store min/max and clipped to [0, 1]: the last 30
    rows with all 20 past features (plan -1, steps -29 to 0) and the 18 known-future features of every plan."""
    future = _future_scaled(spark, sf, clip=True)
    z = scaling.minmax_over_partition(tables.feature_table(spark, sf), PAST_FEATURES)
    past = windows.latest_window(z).select(
        "Store", F.lit("past").alias("stream"), F.lit(-1).alias("plan"), (F.col("row_position") - F.col("n_rows") + 1).cast("int").alias("step"),
        *[r4(clip_expr(F.col(f"{c}_scaled"))).alias(f"{c}_scaled") for c in [*FUTURE_FEATURES, *_PAST_ONLY]])
    empty = [F.lit(None).cast("double").alias(f"{c}_scaled") for c in _PAST_ONLY]
    return future.select("Store", F.lit("future").alias("stream"), "plan", "step", *[f"{c}_scaled" for c in FUTURE_FEATURES], *empty) \
        .unionByName(past)


@register("clip_unit", sql("""
SELECT Store, plan, step, lag_7_sales_scaled AS raw_scaled, LEAST(GREATEST(lag_7_sales_scaled, 0.0), 1.0) AS clipped
FROM (""" + _scale_sql(False) + ")", "future_pred", "future_dates", "features"))
def clip_unit(spark, sf):
    """Scaled values before / after clipping to [0, 1]."""
    s = _future_scaled(spark, sf, clip=False)
    return s.select("Store", "plan", "step", F.col("lag_7_sales_scaled").alias("raw_scaled"),
                    clip_expr(F.col("lag_7_sales_scaled")).alias("clipped"))


@register("closed_day_zero", sql("""
SELECT Store, step, date, open, ROUND(lag_7_sales, 4) AS lag_7_sales, predicted_sales FROM future_pred_cal""",
                                 "future_pred_cal"))
def closed_day_zero(spark, sf):
    """Prediction forced to 0 on closed days (calendar-days mode)."""
    return _rows(spark, sf, open_days_only=False).select("Store", "step", "date", "open",
                                                         r4("lag_7_sales").alias("lag_7_sales"), "predicted_sales")


@register("round_units", sql("""
SELECT Store, Date, ROUND(rolling_14_sales, 4) AS rolling_14_sales,
       CAST(round_even(rolling_14_sales, 0) AS BIGINT) AS rolling_14_units FROM features""", "features"))
def round_units(spark, sf):
    """Round half to even to whole units (x.5 ties occur on 14-row means)."""
    from ..functions.metrics import round_units as ru
    return tables.feature_table(spark, sf).select("Store", "Date", r4("rolling_14_sales").alias("rolling_14_sales"),
                                                    ru(F.col("rolling_14_sales")).alias("rolling_14_units"))


@register("demand_level", sql("""
SELECT Store, step, predicted_sales,
       CASE WHEN predicted_sales >= 100 THEN 'high' WHEN predicted_sales >= 50 THEN 'medium' ELSE 'low' END AS demand_level
FROM future_pred""", "future_pred"))
def demand_level(spark, sf):
    """Demand level with thresholds as parameters (100 / 50 for this panel;
    the service default is 4500 / 3500)."""
    r = _rows(spark, sf)
    return r.select("Store", "step", "predicted_sales",
                    level_expr(F.col("predicted_sales"), DemandThresholds(100, 50)).alias("demand_level"))


_WD = "CASE day_of_week WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu' WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' WHEN 7 THEN 'Sun' ELSE '' END"


@register("forecast_rows", sql(f"""
SELECT Store, date, day_of_week, {_WD} AS weekday, CAST(day_of_week IN (6, 7) AS INTEGER) AS is_weekend,
       0 AS promo, 0 AS school_holiday, predicted_sales,
       CASE WHEN predicted_sales >= 4500 THEN 'high' WHEN predicted_sales >= 3500 THEN 'medium' ELSE 'low' END AS demand_level
FROM future_pred""", "future_pred"))
def forecast_rows(spark, sf):
    """Per-day forecast records of the default request for every store."""
    return _rows(spark, sf).select("Store", "date", "day_of_week", "weekday", "is_weekend", "promo",
                                   "school_holiday", "predicted_sales", "demand_level")


_REC_FREE = f"'{dc.TEXT_NO_STOCK}'"
_RESP = """
SELECT Store, CAST(SUM(predicted_sales) AS BIGINT) AS total_predicted_sales,
       CAST(trunc(SUM(predicted_sales) / COUNT(*)) AS BIGINT) AS average_predicted_sales,
       arg_max(date, predicted_sales * 100 - step) AS highest_demand_day,
       arg_min(date, predicted_sales * 100 + step) AS lowest_demand_day,
       max(latest_date) AS latest_historical_date, COUNT(*) AS n_days
FROM future_pred GROUP BY Store"""


@register("forecast_response", sql(f"""
SELECT r.Store, 'LinearPlan' AS model_name, 'v1' AS model_version, 'open days only' AS forecast_mode,
       latest_historical_date, 7 AS forecast_days, total_predicted_sales, average_predicted_sales,
       highest_demand_day, lowest_demand_day, CAST(n_days AS INTEGER) AS n_days, d.forecast, {_REC_FREE} AS recommendation
FROM ({_RESP}) r JOIN (
  SELECT Store, string_agg(strftime(date, '%Y-%m-%d') || ' ' || {_WD} || ' ' || predicted_sales || ' ' ||
         CASE WHEN predicted_sales >= 4500 THEN 'high' WHEN predicted_sales >= 3500 THEN 'medium' ELSE 'low' END, ', ' ORDER BY step) AS forecast
  FROM future_pred GROUP BY Store) d ON d.Store = r.Store""", "future_pred"))
def forecast_response(spark, sf):
    """The whole response per store: mode, latest date, totals, peak / trough, the day
    records (nested, parsed back from the stored JSON and shown as text) and the
    insights' recommendation."""
    f = dc.with_insights(_default(spark, sf))
    f = f.withColumn("response_average", (F.col("total_predicted_sales") / F.size("days")).cast("bigint")).withColumn("created_at", F.col("latest_date").cast("timestamp_ntz"))
    r = hs.parse_response(hs.log_rows(f)).select("response.*")
    days = F.array_join(F.transform("forecast", lambda d: F.concat_ws(
        " ", d["date"], d["weekday"], d["predicted_sales"], d["demand_level"])), ", ")
    return r.select(F.col("store_id").alias("Store"), "model_name", "model_version", "forecast_mode",
                    F.to_date("latest_historical_date").alias("latest_historical_date"), "forecast_days",
                    "total_predicted_sales", "average_predicted_sales", F.to_date("highest_demand_day").alias("highest_demand_day"),
                    F.to_date("lowest_demand_day").alias("lowest_demand_day"), F.size("forecast").alias("n_days"),
                    days.alias("forecast"), F.col("business_insights.recommendation").alias("recommendation"))


@register("forecast_totals", sql(f"SELECT Store, total_predicted_sales, average_predicted_sales FROM ({_RESP})",
                                 "future_pred"))
def forecast_totals(spark, sf):
    """Total and truncated average of the rounded predictions."""
    return _default(spark, sf).select("Store", "total_predicted_sales", "average_predicted_sales")


@register("peak_trough_day", sql(f"SELECT Store, highest_demand_day, lowest_demand_day FROM ({_RESP})",
                                 "future_pred"))
def peak_trough_day(spark, sf):
    """First date with the highest / lowest rounded prediction."""
    return _default(spark, sf).select("Store", "highest_demand_day", "lowest_demand_day")


@register("rank_forecast_days", sql("""
SELECT Store, date, predicted_sales, CAST(ROW_NUMBER() OVER (PARTITION BY Store ORDER BY predicted_sales DESC, date) AS INTEGER) AS rank,
       ROW_NUMBER() OVER (PARTITION BY Store ORDER BY predicted_sales DESC, date) = 1 AS is_highest,
       ROW_NUMBER() OVER (PARTITION BY Store ORDER BY predicted_sales DESC, date) = COUNT(*) OVER (PARTITION BY Store) AS is_lowest
FROM future_pred""", "future_pred"))
def rank_forecast_days(spark, sf):
    """Days by prediction descending (stable: date order on ties); highest =
    first, lowest = last. The rank is computed inside each forecast's array."""
    r = _default(spark, sf)
    ranked = F.array_sort(F.col("days"), lambda a, b: F.when(a["predicted_sales"] > b["predicted_sales"], -1)
                          .when(a["predicted_sales"] < b["predicted_sales"], 1)
                          .when(a["date"] < b["date"], -1).when(a["date"] > b["date"], 1).otherwise(0))
    n = F.size("days")
    out = r.select("Store", F.posexplode(ranked).alias("pos", "d"), n.alias("_n"))
    return out.select("Store", F.col("d.date").alias("date"), F.col("d.predicted_sales").alias("predicted_sales"),
                      (F.col("pos") + 1).cast("int").alias("rank"), (F.col("pos") == 0).alias("is_highest"),
                      (F.col("pos") == F.col("_n") - 1).alias("is_lowest"))


# ---- decisions and scenarios ------------------------------------------------------------------

@register("cross_scenarios", sql("""
SELECT s.Store, c.position, c.name, c.current_stock, c.unit_price, c.reorder_lead_time_days,
       c.safety_stock_percentage, CAST(CASE WHEN c.promo THEN 2 ELSE 0 END AS INTEGER) AS n_promo_dates
FROM state s CROSS JOIN scenarios c""", "state", "scenarios"))
def cross_scenarios(spark, sf):
    """Every scenario of a table evaluated on every store's history."""
    _, st = _state(spark, sf)
    s = rq.attach_scenarios(st, rq.scenario_table(spark))
    return s.select("Store", "position", "name", "current_stock", "unit_price", "reorder_lead_time_days",
                    "safety_stock_percentage", F.size("promo_dates").alias("n_promo_dates"))


_SI = "Store, position"


def _ins(name, cols_sql, cols_spark, doc):
    def build(spark, sf):
        return _scen(spark, sf).select("Store", "position", *cols_spark())
    build.__doc__ = doc
    register(name, sql(f"SELECT {_SI}, {cols_sql} FROM scen_ins", "scen_ins"))(build)


_ins("insight_totals", "total AS total_predicted_sales, avg_ins AS average_predicted_sales",
     lambda: ["total_predicted_sales", "average_predicted_sales"],
     "Total and half-even average of the predictions per scenario.")
_ins("insight_revenue", "ROUND(expected_revenue, 4) AS expected_revenue",
     lambda: [r4("expected_revenue").alias("expected_revenue")], "Total x unit price (NULL without a price).")
_ins("insight_projected_stock", "current_stock, projected AS projected_stock_after_7_days",
     lambda: ["current_stock", "projected_stock_after_7_days"], "Stock minus total demand (NULL without stock).")
_ins("insight_reorder_point", "ROUND(safety_stock, 4) AS safety_stock, ROUND(reorder_point, 4) AS reorder_point",
     lambda: [r4("safety_stock").alias("safety_stock"), r4("reorder_point").alias("reorder_point")],
     "avg x lead time + total x safety share.")
_ins("insight_stockout_risk", "risk AS stockout_risk, needed AS reorder_needed",
     lambda: ["stockout_risk", "reorder_needed"], "high / medium / low and the reorder flag.")
_ins("insight_reorder_qty", "qty AS recommended_reorder_quantity", lambda: ["recommended_reorder_quantity"],
     "max(0, round(total + safety - stock)) when a reorder is needed.")

_REC = f"""CASE WHEN current_stock IS NULL THEN '{dc.TEXT_NO_STOCK}' WHEN risk = 'high' THEN '{dc.TEXT_HIGH}'
            WHEN risk = 'medium' THEN '{dc.TEXT_MEDIUM}' ELSE '{dc.TEXT_LOW}' END"""


@register("insight_recommendation", sql(f"SELECT {_SI}, {_REC} AS recommendation FROM scen_ins", "scen_ins"))
def insight_recommendation(spark, sf):
    """Recommendation text by risk level."""
    return _scen(spark, sf).select("Store", "position", "recommendation")


@register("scenario_compare", sql(f"""
SELECT {_SI}, name, total AS total_predicted_sales, avg_ins AS average_predicted_sales,
       ROUND(expected_revenue, 4) AS expected_revenue, current_stock, projected AS projected_stock_after_7_days,
       risk AS stockout_risk, qty AS recommended_reorder_quantity, needed AS reorder_needed, {_REC} AS recommendation
FROM scen_ins""", "scen_ins"))
def scenario_compare(spark, sf):
    """Forecast + insights for the scenarios of a table on every store."""
    _, st = _state(spark, sf)
    s = dc.with_insights(fc.forecast_joined(rq.attach_scenarios(st, rq.scenario_table(spark))))
    return s.select("Store", "position", "name", "total_predicted_sales", "average_predicted_sales",
                    r4("expected_revenue").alias("expected_revenue"), "current_stock", "projected_stock_after_7_days",
                    "stockout_risk", "recommended_reorder_quantity", "reorder_needed", "recommendation")


@register("scenario_score", sql(f"SELECT {_SI}, has_stock, ROUND(score, 4) AS score FROM scen_score", "scen_score"))
def scenario_score(spark, sf):
    """Scenario score: risk points + no-reorder bonus + 0.01 projected - 0.05 qty, or total sales without stock."""
    s = dc.score_scenarios(_scen(spark, sf))
    return s.select("Store", "position", "has_stock", r4("score").alias("score"))


@register("best_scenario", sql(f"""
SELECT Store, CAST(cnt AS BIGINT) AS scenario_count, name AS best_scenario, position AS best_position,
       ROUND(score, 4) AS best_score,
       CASE WHEN has_stock THEN '{dc.REASON_STOCK}' ELSE '{dc.REASON_SALES}' END AS reason, comparable
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY score DESC, position) AS r,
             COUNT(*) OVER (PARTITION BY Store) AS cnt,
             MIN(CAST(has_stock AS INTEGER)) OVER (PARTITION BY Store) = MAX(CAST(has_stock AS INTEGER)) OVER (PARTITION BY Store) AS comparable
      FROM scen_score) WHERE r = 1""", "scen_score"))
def best_scenario(spark, sf):
    """Highest score per store, the first scenario wins ties, reason by branch."""
    b = dc.best_scenario(dc.score_scenarios(_scen(spark, sf)))
    return b.select("Store", "scenario_count", "best_scenario", F.col("best_position").alias("best_position"),
                    r4("best_score").alias("best_score"), "reason", "comparable")


@register("risk_normalise", sql(f"SELECT {_SI}, lower(COALESCE(risk, 'high')) AS risk FROM scen_ins", "scen_ins"))
def risk_normalise(spark, sf):
    """Case-folded risk, 'high' when missing (as the scorer reads it)."""
    return _scen(spark, sf).select("Store", "position", risk_expr(F.col("stockout_risk")).alias("risk"))


@register("insight_alias_coalesce", sql(f"""
SELECT {_SI}, ROUND(expected_revenue, 4) AS revenue, projected AS projected_stock FROM scen_ins""", "scen_ins"))
def insight_alias_coalesce(spark, sf):
    """Either spelling of revenue / projected stock is accepted."""
    s = _scen(spark, sf).withColumnRenamed("projected_stock_after_7_days", "projected_stock_after_forecast")
    s = dc.alias_coalesce(s, ["projected_revenue", "expected_revenue"], "revenue")
    s = dc.alias_coalesce(s, ["projected_stock_after_7_days", "projected_stock_after_forecast"], "projected_stock")
    return s.select("Store", "position", r4("revenue").alias("revenue"), "projected_stock")


_FMT_REV = "'$' || format('{:,.2f}', COALESCE(expected_revenue, 0.0))"


@register("scenario_table", sql(f"""
SELECT Store, metric, {', '.join(f"max(CASE WHEN position = {p} THEN value END) AS s{p}" for p in range(5))}
FROM (
  SELECT Store, position, 'Total Sales' AS metric, format('{{:,}}', total) AS value FROM scen_ins
  UNION ALL SELECT Store, position, 'Projected Revenue', {_FMT_REV} FROM scen_ins
  UNION ALL SELECT Store, position, 'Stockout Risk', lower(risk) FROM scen_ins
  UNION ALL SELECT Store, position, 'Reorder Needed?', CASE WHEN needed THEN 'Yes' ELSE 'No' END FROM scen_ins
  UNION ALL SELECT Store, position, 'Reorder Qty', format('{{:,}}', COALESCE(qty, 0)) FROM scen_ins)
GROUP BY Store, metric""", "scen_ins"))
def scenario_table(spark, sf):
    """Metric x scenario matrix: unpivot the formatted metrics, pivot scenarios
    (pivot values given: no extra distinct job)."""
    s = _scen(spark, sf)
    metrics = s.select(
        "Store", "position",
        fmt.fmt_number(F.col("total_predicted_sales")).alias("Total Sales"),
        fmt.fmt_currency(F.coalesce(F.col("expected_revenue"))).alias("Projected Revenue"),
        F.lower("stockout_risk").alias("Stockout Risk"),
        F.when(F.col("reorder_needed"), "Yes").otherwise("No").alias("Reorder Needed?"),
        fmt.fmt_number(F.coalesce(F.col("recommended_reorder_quantity"), F.lit(0))).alias("Reorder Qty"))
    long = metrics.unpivot(["Store", "position"], ["Total Sales", "Projected Revenue", "Stockout Risk",
                                                    "Reorder Needed?", "Reorder Qty"], "metric", "value")
    wide = long.groupBy("Store", "metric").pivot("position", list(range(5))).agg(F.first("value"))
    return wide.select("Store", "metric", *[F.col(str(p)).alias(f"s{p}") for p in range(5)])


@register("scenario_report_rows", sql("""
SELECT Store, position, name AS "Scenario", total AS "Total Sales",
       CASE WHEN COALESCE(expected_revenue, 0) = 0 THEN '' ELSE CAST(expected_revenue AS VARCHAR) END AS "Revenue",
       risk AS "Stockout Risk", CASE WHEN needed THEN 'Yes' ELSE 'No' END AS "Reorder Needed",
       COALESCE(qty, 0) AS "Recommended Qty"
FROM scen_ins""", "scen_ins"))
def scenario_report_rows(spark, sf):
    """Flat report rows of a scenario comparison (CSV export shape)."""
    s = _scen(spark, sf)
    rev = F.when(F.coalesce(F.col("expected_revenue"), F.lit(0.0)) == 0, F.lit("")).otherwise(
        F.col("expected_revenue").cast("string"))
    return s.select("Store", "position", F.col("name").alias("Scenario"),
                    F.col("total_predicted_sales").alias("Total Sales"), rev.alias("Revenue"),
                    F.col("stockout_risk").alias("Stockout Risk"),
                    F.when(F.col("reorder_needed"), "Yes").otherwise("No").alias("Reorder Needed"),
                    F.coalesce(F.col("recommended_reorder_quantity"), F.lit(0).cast("bigint")).alias("Recommended Qty"))


@register("merge_scenarios_by_date", sql(f"""
SELECT Store, date, {', '.join(f"max(CASE WHEN position = {p} THEN predicted_sales END) AS s{p}" for p in range(5))}
FROM scen_future GROUP BY Store, date""", "scen_future"))
def merge_scenarios_by_date(spark, sf):
    """All scenario forecasts of a store aligned by date (one column per scenario)."""
    rows = fc.forecast_rows(_scen(spark, sf), ("Store", "position"))
    wide = rows.groupBy("Store", "date").pivot("position", list(range(5))).agg(F.first("predicted_sales"))
    return wide.select("Store", "date", *[F.col(str(p)).alias(f"s{p}") for p in range(5)])


@register("fmt_number", sql("SELECT Store, position, format('{:,}', total) AS total_text FROM scen_ins", "scen_ins"))
def fmt_number(spark, sf):
    """Thousands separators (en-US)."""
    return _scen(spark, sf).select("Store", "position",
                                   fmt.fmt_number(F.col("total_predicted_sales")).alias("total_text"))


@register("fmt_currency", sql(f"SELECT Store, position, {_FMT_REV} AS revenue_text FROM scen_ins", "scen_ins"))
def fmt_currency(spark, sf):
    """USD currency text; NULL reads $0.00."""
    return _scen(spark, sf).select("Store", "position", fmt.fmt_currency(F.col("expected_revenue")).alias("revenue_text"))


@register("fmt_pct", sql("""
SELECT Store, forecast_day, format('{:.1f}', ROUND(mape, 6)) || '%' AS mape_text FROM (
  SELECT Store, forecast_day, avg(percentage_error) AS mape FROM preds_weekly GROUP BY 1, 2)""", "preds_weekly"))
def fmt_pct(spark, sf):
    """Percent text with one decimal (MAPE per store and horizon day)."""
    from ..operators import evaluate as ev
    from ..operators import windows
    p = ev.prediction_records(windows.horizon_rows(tables.feature_table(spark, sf)), "weekly_seasonal")
    m = p.groupBy("Store", "forecast_day").agg(F.avg("percentage_error").alias("mape"))
    return m.select("Store", "forecast_day", fmt.fmt_pct(F.round("mape", 6)).alias("mape_text"))


@register("fmt_date", sql("""
SELECT Store, step, strftime(date, '%a, %b %-d') AS date_text, strftime(date, '%A') AS weekday_text FROM future_pred""",
                          "future_pred"))
def fmt_date(spark, sf):
    """'Mon, Jul 14' and the long weekday name of every forecast day."""
    return _rows(spark, sf).select("Store", "step", fmt.fmt_date(F.col("date")).alias("date_text"),
                                   fmt.fmt_weekday(F.col("date")).alias("weekday_text"))


@register("fmt_weekday", sql("SELECT Store, step, strftime(date, '%A') AS weekday_text FROM future_pred", "future_pred"))
def fmt_weekday(spark, sf):
    """Long weekday name of every forecast day."""
    return _rows(spark, sf).select("Store", "step", fmt.fmt_weekday(F.col("date")).alias("weekday_text"))


@register("sink_forecast_csv", sql("""
SELECT Store, 'open' AS mode, date, day_of_week, predicted_sales, CAST(NULL AS INTEGER) AS open FROM future_pred
UNION ALL
SELECT Store, 'calendar' AS mode, date, day_of_week, predicted_sales, open FROM future_pred_cal""",
                                   "future_pred", "future_pred_cal"))
def sink_forecast_csv(spark, sf):
    """7-day forecasts of both modes written as CSV in one job, a folder per mode;
    the open column is filled in calendar mode only."""
    from ..session import scratch_path
    from ..sources import files
    _, st = _state(spark, sf)
    # both modes from one state row per store, written as text lines of their own column lists
    modes = F.inline(F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(o).alias("_open_only")) for m, o in (("open", True), ("calendar", False))]))
    both = rq.default_requests(st).drop("forecast_open_days_only").select("*", modes) \
        .withColumnRenamed("_open_only", "forecast_open_days_only")
    rows = fc.forecast_rows(fc.forecast_joined(both), ("Store", "mode")).select(
        "Store", "date", "day_of_week", "predicted_sales", "open", "mode")
    path = scratch_path(spark, "forecast_csv")
    rows.withColumn("open", F.when(F.col("mode") == "calendar", F.col("open"))) \
        .write.partitionBy("mode").option("header", True).csv(path)
    back = files.read_csv(spark, path, rows.drop("mode").schema)
    return back.select("Store", "mode", "date", "day_of_week", "predicted_sales", "open")
