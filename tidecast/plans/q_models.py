"""Queries: model training and scoring (2.9 re-aimed) and the streaming request
intake (2.12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import arraymodels as am
from ..operators import blocks as bl
from ..operators import evaluate as ev
from ..operators import forecast as fc
from ..operators import models as md
from ..operators import windows
from ..params import FUTURE_FEATURES, PAST_FEATURES
from ..session import scratch_path
from ..sources import files, panel
from ..streaming import intake, snapshot
from . import tables
from . import requests as rq
from . import q_history  # noqa: F401  (its SQL parts are used here)
from .oracle import sql
from .registry import r4, register


def _rows(spark, sf):
    feat = tables.feature_table(spark, sf)
    h = windows.horizon_rows(feat, extra=md.KNOWN_AHEAD)
    # the long training table is read by several fits: write it once to the
    # shared folder (cuts the lineage; a lost executor re-reads files)
    return files.materialize(spark, md.training_rows(h), "model_rows")


def _naive_sql(*methods: str) -> str:
    """Per method: windows of the fit, test points and the naive baselines' errors, all counted here."""
    return " UNION ALL ".join(f"""
SELECT '{m}' AS method, count(*) FILTER (split = 'train' AND forecast_day = 1) AS n_fit_windows, count(*) FILTER (split = 'test') AS n_points,
       ROUND(avg(abs(actual_sales - last_value)) FILTER (split = 'test'), 4) AS last_value_mae,
       ROUND(avg(abs(actual_sales - weekly_seasonal)) FILTER (split = 'test'), 4) AS weekly_seasonal_mae,
       true AS beats_last_value, true AS beats_weekly_seasonal FROM horizon""" for m in methods)


def _verdict(errors, method: str, n_fit: int):
    """The row of a fitted model from ``arraymodels.errors``."""
    return errors.select(F.lit(method).alias("method"), F.lit(n_fit).cast("bigint").alias("n_fit_windows"), "n_points",
                         r4("last_value").alias("last_value_mae"), r4("weekly_seasonal").alias("weekly_seasonal_mae"),
                         (F.col("model") < F.col("last_value")).alias("beats_last_value"),
                         (F.col("model") < F.col("weekly_seasonal")).alias("beats_weekly_seasonal"))


#: The arrays of the real panel: both streams, the target and the planned events in units, scalers of what is planned.
PLANNED = ("Promo", "promo_schoolholiday", "promo_weekend")
PANEL = bl.Layout(tuple(PAST_FEATURES), tuple(FUTURE_FEATURES), raw=("Sales", "Promo", "SchoolHoliday", "IsWeekend"),
                  scalers=("Sales", *PLANNED))


def _blocks(spark, sf):
    """The blocks of the panel, written once; blocks of one series are spread over tasks."""
    blocks = bl.time_blocks(tables.feature_table(spark, sf), PANEL)
    return files.materialize(spark, blocks.repartition("Store", "block").sortWithinPartitions("Store", "block"), "model_blocks")


def _kept(spark, model):
    """The model after a round through its file."""
    return am.load(spark, am.save(spark, model, scratch_path(spark, "model")))


@register("train_direct_horizon", sql(_naive_sql("ridge"), "horizon"))
def train_direct_horizon(spark, sf):
    """Ridge regression of the seven scaled targets on all 30 x 20 past and 7 x 18 future inputs, in one pass over
    the train windows; saved, loaded, and scored on every test window."""
    blocks = _blocks(spark, sf)
    xx, xy, n = am.gram(blocks, PANEL)
    model = _kept(spark, am.solve_ridge(xx, xy, n, reg=1e-3))

    def predict(w):
        return np.maximum(model.predict(w.inputs) * w.row["range_Sales"] + w.row["lo_Sales"], 0.0)
    return _verdict(am.errors(blocks, PANEL, predict), "ridge", n)


# Two inputs of the subset fit: the last value and the value a week before the first target day.
_SUBSET = (29, 23)

@register("train_direct_horizon_subset", sql(f"""
SELECT forecast_day, n AS n_fit_windows, ROUND(b1, 4) + 0.0 AS w_last, ROUND(b2, 4) + 0.0 AS w_week,
       ROUND(my - b1 * m1 - b2 * m2, 4) + 0.0 AS constant
FROM (SELECT *, (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2 FROM (
  SELECT forecast_day, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2,
         covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y
  FROM (SELECT row_position - 29 AS s, CAST(d.d AS INTEGER) AS forecast_day, z AS x1, LAG(z, 6) OVER w AS x2, LEAD(z, d.d) OVER w AS y,
               CAST(floor(GREATEST(n_rows - 36, 0) * 0.8) AS INTEGER) AS train_size
        FROM (SELECT Store, Date, row_position, n_rows, (Sales - MIN(CAST(Sales AS DOUBLE)) OVER q) /
                     CASE WHEN MAX(Sales) OVER q = MIN(Sales) OVER q THEN 1.0 ELSE MAX(Sales) OVER q - MIN(CAST(Sales AS DOUBLE)) OVER q END AS z
              FROM features WINDOW q AS (PARTITION BY Store)), range(1, 8) d(d)
        WINDOW w AS (PARTITION BY Store, d.d ORDER BY Date))
  WHERE s >= 0 AND s < train_size GROUP BY forecast_day))""", "features"))
def train_direct_horizon_subset(spark, sf):
    """The same fit from two of its inputs without a ridge: weights equal the normal equations solved in SQL."""
    xx, xy, n = am.gram(_blocks(spark, sf), PANEL)
    at = [t * len(PANEL.past) + PANEL.past.index("Sales") for t in _SUBSET]
    w = am.solve_ridge(xx, xy, n, reg=0.0, inputs=at).arrays["w"]
    rows = [(d + 1, n, *[round(float(w[i, d]), 4) + 0.0 for i in (*at, -1)]) for d in range(PANEL.wp.horizon)]
    return spark.createDataFrame(rows, "forecast_day int, n_fit_windows bigint, w_last double, w_week double, constant double")


def _residual_blocks(spark, sf):
    """Blocks with mean and std of each series' residual (actual - same weekday a week before) over its train windows."""
    blocks = _blocks(spark, sf)

    def sums(w):
        r = _residual(w)[w.of("train")]
        return pa.RecordBatch.from_arrays([pa.array([w.row["Store"]], pa.int32()), pa.array([r.size]), pa.array([float(r.sum())]),
                                           pa.array([float((r * r).sum())])], ["Store", "n", "s", "q"])
    per = bl.map_windows(blocks, PANEL, sums, "Store int, n bigint, s double, q double").groupBy("Store").agg(
        (F.sum("s") / F.sum("n")).alias("residual_mean"),
        F.sqrt(F.greatest(F.sum("q") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), 2), F.lit(0.0))).alias("std"))
    per = per.select("Store", F.coalesce("residual_mean", F.lit(0.0)).alias("residual_mean"),
                     F.when(F.col("std") > 0, F.col("std")).otherwise(1.0).alias("residual_std"))
    joined = blocks.join(per, "Store").repartition("Store", "block").sortWithinPartitions("Store", "block")
    return files.materialize(spark, joined, "residual_blocks")


def _weekly(w):
    return w.behind("raw_Sales")[:, -PANEL.wp.horizon:]


def _residual(w):
    return w.ahead("raw_Sales") - _weekly(w)


def _fit_residual(spark, sf):
    blocks = _residual_blocks(spark, sf)
    fit = am.fit_network(blocks, PANEL, label=lambda w: (_residual(w) - w.row["residual_mean"]) / w.row["residual_std"])
    return blocks, fit


@register("train_residual", sql(_naive_sql("residual_network"), "horizon"))
def train_residual(spark, sf):
    """A network on the standard-scaled residual, fitted in rounds over the blocks with a validation monitor that
    restores the best weights; saved, loaded; final = weekly baseline + residual scaled back."""
    blocks, fit = _fit_residual(spark, sf)
    model = _kept(spark, fit.model)

    def predict(w):
        return np.maximum(_weekly(w) + model.predict(w.inputs) * w.row["residual_std"] + w.row["residual_mean"], 0.0)
    n = blocks.select("Store", "train_size").distinct().agg(F.sum("train_size")).first()[0]
    return _verdict(am.errors(blocks, PANEL, predict), "residual_network", n)


@register("train_residual_rounds", None)
def train_residual_rounds(spark, sf):
    """Validation loss of every round of that fit, the round whose weights are kept and whether it stopped early."""
    _, fit = _fit_residual(spark, sf)
    rows = [(k, loss, k == fit.best_round, fit.stopped_early) for k, loss in enumerate(fit.losses)]
    return spark.createDataFrame(rows, "round int, validation_loss double, kept boolean, stopped_early boolean")


@register("train_direct_trees", sql(_naive_sql("linear", "gbt"), "horizon"))
def train_direct_trees(spark, sf):
    """Spark ML models on the long (window, day) rows: linear (L2) and boosted trees with early stopping on the
    chronological validation split."""
    rows = _rows(spark, sf)
    fit_rows = md.fit_rows(rows)
    lin = md.score(md.fit(rows, md.linear_pipeline()), rows).withColumnRenamed("model_prediction", "linear")
    gbt = md.score(md.fit(rows, md.gbt_pipeline()), lin).withColumnRenamed("model_prediction", "gbt")
    mae = {m: F.avg(F.abs(F.col("actual_sales") - F.col(m))).alias(m) for m in ("linear", "gbt", "last_value", "weekly_seasonal")}
    agg = gbt.filter("split = 'test'").agg(F.count(F.lit(1)).alias("n_points"), *mae.values())
    n_fit = fit_rows.filter("forecast_day_i = 1").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return agg.select("*", F.inline(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("model")) for m in ("linear", "gbt")]))) \
        .select("method", n_fit.alias("n_fit_windows"), "n_points", r4("last_value").alias("last_value_mae"),
                r4("weekly_seasonal").alias("weekly_seasonal_mae"), (F.col("model") < F.col("last_value")).alias("beats_last_value"),
                (F.col("model") < F.col("weekly_seasonal")).alias("beats_weekly_seasonal"))


# A model given from outside: its weights by rule, so that SQL can state them. Past input (step t, feature f)
# of day d weighs past_step(d, t) * past_feature(f), future inputs likewise; all counted from 1.
WINDOW_SCENARIOS = [(0, None), (1, 0), (2, 1)]   # (fixed values) planned promotion of the horizon, null = as in the data
_PAST_STEP = "((({t}) * ({d} + 2)) % 30 + 1) / 300.0"
_PAST_FEATURE = "((7 * {f} + 3) % 20 - 9.5) / 40.0"
_AHEAD_STEP = "((({t}) + {d}) % 7 + 1) / 10.0"
_AHEAD_FEATURE = "((5 * {f} + 2) % 18 - 8) / 20.0"
_CONSTANT = "0.4 + 0.02 * {d}"


def given_model() -> am.ArrayModel:
    """The weights of the rules above as arrays."""
    days, w = range(1, PANEL.wp.horizon + 1), []
    for d in days:
        past = [(t * (d + 2) % 30 + 1) / 300.0 * (((7 * f + 3) % 20 - 9.5) / 40.0)
                for t in range(1, PANEL.wp.lookback + 1) for f in range(1, len(PANEL.past) + 1)]
        ahead = [((t + d) % 7 + 1) / 10.0 * (((5 * f + 2) % 18 - 8) / 20.0) for t in days for f in range(1, len(PANEL.future) + 1)]
        w.append([*past, *ahead, 0.4 + 0.02 * d])
    return am.ArrayModel("linear", {"w": np.array(w).T})


def _scaled_sql(c: str, value: str) -> str:
    """``value`` scaled by the bounds of the column c."""
    lo, hi = f"MIN(CAST({c} AS DOUBLE)) OVER q", f"MAX(CAST({c} AS DOUBLE)) OVER q"
    return f"(CAST({value} AS DOUBLE) - {lo}) / CASE WHEN {hi} = {lo} THEN 1.0 ELSE {hi} - {lo} END"


def _ahead_sql(c: str) -> str:
    value = {"Promo": "p", "promo_schoolholiday": "p * SchoolHoliday", "promo_weekend": "p * IsWeekend"}.get(c)
    z = _scaled_sql(c, value or c)
    return f"LEAST(GREATEST({z}, 0.0), 1.0)" if value else z


def _score_sql() -> str:
    u = " + ".join(f"{_PAST_FEATURE.format(f=i + 1)} * ({_scaled_sql(c, c)})" for i, c in enumerate(PANEL.past))
    v = " + ".join(f"{_AHEAD_FEATURE.format(f=i + 1)} * ({_ahead_sql(c)})" for i, c in enumerate(PANEL.future))

    def day(d):
        past = f"list_sum(list_transform(us, lambda x, i: x * {_PAST_STEP.format(d=d, t='i')}))"
        ahead = f"list_sum(list_transform(vs, lambda x, i: x * {_AHEAD_STEP.format(d=d, t='i')}))"
        return f"GREATEST(({_CONSTANT.format(d=d)} + {past} + {ahead}) * rng + lo, 0.0)"
    days = range(1, PANEL.wp.horizon + 1)
    error = " + ".join(f"abs(ys[{d}] - p{d})" for d in days)
    return f"""
SELECT Store, scenario, sample_index, split, {", ".join(f"ROUND(p{d}, 4) AS p{d}" for d in days)}, ROUND(({error}) / 7, 4) AS mae
FROM (SELECT *, {", ".join(f"{day(d)} AS p{d}" for d in days)} FROM (
  SELECT Store, scenario, CAST(row_position - 29 AS INTEGER) AS sample_index, lo, rng, GREATEST(n_rows - 36, 0) AS n_windows,
         CASE WHEN row_position - 29 >= CAST(floor(GREATEST(n_rows - 36, 0) * 0.8) AS INTEGER) THEN 'test' ELSE 'train' END AS split,
         list(u) OVER (PARTITION BY Store, scenario ORDER BY Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS us,
         list(v) OVER (PARTITION BY Store, scenario ORDER BY Date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS vs,
         list(Sales) OVER (PARTITION BY Store, scenario ORDER BY Date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS ys
  FROM (SELECT *, {u} AS u, {v} AS v, MIN(CAST(Sales AS DOUBLE)) OVER q AS lo,
               CASE WHEN MAX(Sales) OVER q = MIN(Sales) OVER q THEN 1.0 ELSE MAX(Sales) OVER q - MIN(CAST(Sales AS DOUBLE)) OVER q END AS rng
        FROM (SELECT f.*, s.scenario, COALESCE(s.planned, f.Promo) AS p FROM features f
              CROSS JOIN (VALUES {", ".join(f"({i}, {'NULL' if x is None else x})" for i, x in WINDOW_SCENARIOS)}) s(scenario, planned))
        WINDOW q AS (PARTITION BY Store, scenario)))
  WHERE sample_index >= 0 AND sample_index < n_windows)"""


def _planned_future(planned):
    """The future arrays of a window under a planned promotion (null: as in the data), scaled and clipped."""
    promo = F.transform(bl.ahead_slice("raw_Promo", PANEL), lambda x: F.coalesce(planned.cast("double"), x))
    units = {"Promo": promo, "promo_schoolholiday": F.zip_with(promo, bl.ahead_slice("raw_SchoolHoliday", PANEL), lambda a, b: a * b),
             "promo_weekend": F.zip_with(promo, bl.ahead_slice("raw_IsWeekend", PANEL), lambda a, b: a * b)}

    def one(c):
        if c not in units:
            return bl.ahead_slice(f"z_{c}", PANEL)
        return F.transform(units[c], lambda x: F.least(F.greatest((x - F.col(f"lo_{c}")) / F.col(f"range_{c}"), F.lit(0.0)), F.lit(1.0)))
    return F.array(*[one(c) for c in PANEL.future])


@register("score_windows", sql(_score_sql(), "features"))
def score_windows(spark, sf):
    """A given model, loaded from its file, on the past (30 x 20) and future (7 x 18) arrays of every (store,
    scenario, window): two tensors in Arrow batches, seven values out, scaled back to units."""
    model = _kept(spark, given_model())
    plans = F.array(*[F.struct(F.lit(i).alias("scenario"), F.lit(v).cast("int").alias("planned")) for i, v in WINDOW_SCENARIOS])
    w = bl.time_blocks(tables.feature_table(spark, sf), PANEL).select("*", F.explode(bl.starts(PANEL)).alias("offset")).select("*", F.inline(plans))
    index = F.col("first") + F.col("offset")
    w = w.select("Store", "scenario", index.cast("int").alias("sample_index"), windows.split_label(index, F.col("train_size")).alias("split"),
                 F.array(*[bl.past_slice(f"z_{c}", PANEL) for c in PANEL.past]).alias("past"), _planned_future(F.col("planned")).alias("future"),
                 bl.ahead_slice("raw_Sales", PANEL).alias("actual"), "lo_Sales", "range_Sales")
    p = am.score(w, model, PANEL).withColumn("p", am.in_units("scaled_prediction", "Sales"))
    error = F.aggregate(F.zip_with("actual", "p", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda acc, x: acc + x)
    return p.select("Store", "scenario", "sample_index", "split", *[r4(F.col("p")[d]).alias(f"p{d + 1}") for d in range(PANEL.wp.horizon)],
                    r4(error / PANEL.wp.horizon).alias("mae"))


@register("champion_models", None)
def champion_models(spark, sf):
    """Champion per store over the baselines and the trained linear model."""
    rows = _rows(spark, sf)
    scored = md.score(md.fit(rows, md.linear_pipeline()), rows).withColumnRenamed("model_prediction", "linear")
    t = scored.filter(F.col("split") == "test")
    methods = {"last_value": "last_value", "weekly_seasonal": "weekly_seasonal", "linear": "linear"}
    long = ev.methods_long(t.select("Store", "sample_index", "forecast_day", "actual_sales", *methods.values()),
                           methods)
    m = long.groupBy("Store", "method").agg(*ev.metric_aggs())
    return ev.champion_selection(m).select("Store", "method", r4("mape").alias("mape"), "champion",
                                           r4("gain_pp").alias("gain_pp"), "champion_beats")


_UNKNOWN = 1_000_000   # added to a store number for a request of a store without history

_STREAM_SQL = f"""
SELECT id, store_id, total_predicted_sales, stockout_risk, true AS accepted, '' AS errors FROM log
UNION ALL
SELECT CASE WHEN whole THEN request_id END, CASE WHEN whole THEN CAST(Store AS INTEGER) END, NULL, NULL, false,
       errors FROM req_validated WHERE errors <> ''
UNION ALL
SELECT CAST(Store AS BIGINT) * 100 + {_UNKNOWN * 100}, CAST(Store + {_UNKNOWN} AS INTEGER), NULL, NULL, false, 'Store' FROM state"""


@register("stream_request_intake", sql(_STREAM_SQL, "log", "req_validated", "state"))
def stream_request_intake(spark, sf):
    """Request files drained by a Structured Streaming query (availableNow): every
    line ends in the history or, with its text and errors, in the rejected sink."""
    state = fc.history_state(tables.feature_table(spark, sf))
    known = files.materialize(spark, state, "feature_snapshot")
    raw = rq.request_bodies(known).withColumn(
        "submitted_at", F.col("latest_date").cast("timestamp_ntz") + F.make_interval(hours=F.col("variant")))
    lost = raw.filter("variant = 0").withColumn("Store", F.col("Store") + _UNKNOWN) \
        .withColumn("request_id", F.col("request_id") + _UNKNOWN * 100)
    head = F.format_string('{"request_id": %d, "Store": %d, "submitted_at": "%s", ', "request_id", "Store",
                           F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss"))
    inbox = scratch_path(spark, "intake_inbox")
    lines = raw.select("variant", "Store", "request_id", "submitted_at", "body") \
        .unionByName(lost.select("variant", "Store", "request_id", "submitted_at", "body"))
    # requests arrive as text files of JSON lines, spread over four files
    lines.repartition(4, "request_id").select(F.concat(head, F.col("body").substr(F.lit(2), F.length("body")))).write.text(inbox)
    out = intake.run_intake(spark, inbox, known, max_files_per_trigger=1)  # one batch per file
    hist = spark.read.parquet(out["history"])
    rej = spark.read.parquet(out["rejected"])
    return hist.select("id", "store_id", "total_predicted_sales", "stockout_risk",
                       F.lit(True).alias("accepted"), F.lit("").alias("errors")).unionByName(
        rej.select(F.col("request_id").alias("id"), F.col("Store").alias("store_id"),
                   F.lit(None).cast("bigint").alias("total_predicted_sales"),
                   F.lit(None).cast("string").alias("stockout_risk"), F.lit(False).alias("accepted"),
                   F.array_join("errors", ",").alias("errors")))


@register("stream_feature_snapshot", sql("""
SELECT s.Store, latest_date, ROUND(last_rolling_7_sales, 4) AS last_rolling_7_sales, ROUND(last_rolling_14_sales, 4) AS last_rolling_14_sales,
       ROUND(last_rolling_7_std_sales, 4) AS last_rolling_7_std_sales, last_days_since_promo, ROUND(tail7_mean, 4) AS tail7_mean, closes_on_sundays,
       t.tail_sales
FROM state s JOIN (SELECT Store, CAST(sum(Sales) AS DOUBLE) AS tail_sales FROM features WHERE row_position >= n_rows - 8 GROUP BY Store) t
  ON t.Store = s.Store""", "state", "features"))
def stream_feature_snapshot(spark, sf):
    """The feature snapshot after three increments of the daily fact, each streamed through the state of its stores:
    equals the state recomputed from all rows."""
    days = files.materialize(spark, tables.open_days(panel.sales_daily(spark, sf)).select("Store", "Date", "DayOfWeek", "Sales", "Promo"), "snapshot_days")
    a, b = days.agg(F.percentile_approx(F.unix_date("Date"), [0.5, 0.8], 10_000)).first()[0]
    day = F.unix_date("Date")
    path = snapshot.run(spark, [days.filter(day <= a), days.filter((day > a) & (day <= b)), days.filter(day > b)])
    s = snapshot.latest(spark, path)
    return s.select("Store", "latest_date", *[r4(c).alias(c) for c in ("last_rolling_7_sales", "last_rolling_14_sales", "last_rolling_7_std_sales")],
                    "last_days_since_promo", r4("tail7_mean").alias("tail7_mean"), "closes_on_sundays",
                    F.aggregate("tail", F.lit(0.0), lambda acc, x: acc + x["s"]).alias("tail_sales"))
