"""Queries: window features, calendar scalars, sliding windows, splits,
scalers (SURVEY 2.5, 2.8 calendar/scaling, 2.1 window/scaler sinks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import scaling as scf
from ..operators import blocks as bl
from ..operators import features as fe
from ..operators import scaling, windows
from ..params import (FUTURE_FEATURES, FUTURE_FEATURES_V1, PAST_FEATURES, PAST_FEATURES_V1, SYNTHETIC_FUTURE,
                      SYNTHETIC_FUTURE_V3, SYNTHETIC_PAST, SYNTHETIC_PAST_V3)
from ..sources import files, panel
from . import tables
from .oracle import sql
from .registry import r4, register


TWO_STREAM = bl.Layout(tuple(PAST_FEATURES), tuple(FUTURE_FEATURES))


def _feat(spark, sf):
    return tables.feature_table(spark, sf)


def _fq(name: str, cols: str, spark_cols, doc: str):
    """Register a projection of the feature table."""
    def build(spark, sf):
        return _feat(spark, sf).select("Store", "Date", *spark_cols())
    build.__doc__ = doc
    register(name, sql(f"SELECT Store, Date, {cols} FROM features", "features"))(build)


_fq("lag_7", "lag_7_sales", lambda: ["lag_7_sales"], "Sales 7 rows (open days) earlier.")
_fq("rolling_7_mean", "ROUND(rolling_7_sales, 4) AS rolling_7_sales",
    lambda: [r4("rolling_7_sales").alias("rolling_7_sales")], "Mean of the previous 7 rows, NULL until full.")
_fq("rolling_14_mean", "ROUND(rolling_14_sales, 4) AS rolling_14_sales",
    lambda: [r4("rolling_14_sales").alias("rolling_14_sales")], "Mean of the previous 14 rows.")
_fq("rolling_7_std", "ROUND(rolling_7_std_sales, 4) AS rolling_7_std_sales",
    lambda: [r4("rolling_7_std_sales").alias("rolling_7_std_sales")], "Sample std of the previous 7 rows.")
_fq("sales_vs_lag7", "sales_vs_lag7", lambda: ["sales_vs_lag7"], "Sales minus lag_7_sales (past stream only).")
_fq("days_since_last_promo", "days_since_last_promo", lambda: ["days_since_last_promo"],
    "Rows since the last promo (0 on promo, 9999+row before the first).")
_fq("days_until_next_promo", "days_until_next_promo", lambda: ["days_until_next_promo"],
    "Rows until the next promo (mirror of days_since_last_promo).")
_fq("row_position", "row_position, n_rows", lambda: ["row_position", "n_rows"],
    "0-based chronological row index after the null drop.")
_fq("month_edges", "is_month_start, is_month_end", lambda: ["is_month_start", "is_month_end"],
    "First / last calendar day of the month.")
_fq("is_april", "is_april", lambda: ["is_april"], "Month = 4 flag.")
_fq("interaction_terms", "promo_schoolholiday, weekend_schoolholiday, promo_weekend",
    lambda: ["promo_schoolholiday", "weekend_schoolholiday", "promo_weekend"], "Products of event flags.")


@register("promo_flag_alias", sql("SELECT Store, Date, Promo AS is_promo_day FROM features", "features"))
def promo_flag_alias(spark, sf):
    """is_promo_day = int(Promo)."""
    from ..operators import clean
    return clean.promo_flag_alias(_feat(spark, sf)).select("Store", "Date", "is_promo_day")


@register("drop_incomplete_features", sql("""
SELECT Store, COUNT(*) AS rows_before,
       CAST(SUM(CASE WHEN lag_7_sales IS NOT NULL AND rolling_7_sales IS NOT NULL AND rolling_14_sales IS NOT NULL
                      AND rolling_7_std_sales IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_after
FROM feat_all GROUP BY Store""", "feat_all"))
def drop_incomplete_features(spark, sf):
    """Rows per store before / after dropping incomplete lag/rolling rows."""
    f = fe.engineer_features(tables.processed(spark, sf), drop_incomplete=False)
    from ..params import LAG_COLUMNS
    complete = F.lit(True)
    for c in LAG_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    return f.groupBy("Store").agg(F.count(F.lit(1)).alias("rows_before"),
                                  F.sum(complete.cast("bigint")).alias("rows_after"))


@register("iso_day_of_week", sql("""
SELECT Store, Date, DayOfWeek, CAST(isodow(Date) - 1 AS INTEGER) AS day_of_week0 FROM sales_daily""", "sales_daily"))
def iso_day_of_week(spark, sf):
    """1=Mon..7=Sun and the 0-based variant."""
    return panel.sales_daily(spark, sf).select("Store", "Date", cal.iso_day_of_week(F.col("Date")).alias("DayOfWeek"),
                                               cal.day_of_week0(F.col("Date")).alias("day_of_week0"))


@register("weekday_label", sql("""
SELECT Store, Date, CASE DayOfWeek WHEN 1 THEN 'Mon' WHEN 2 THEN 'Tue' WHEN 3 THEN 'Wed' WHEN 4 THEN 'Thu'
       WHEN 5 THEN 'Fri' WHEN 6 THEN 'Sat' WHEN 7 THEN 'Sun' ELSE '' END AS weekday FROM sales_daily""", "sales_daily"))
def weekday_label(spark, sf):
    """Weekday label of DayOfWeek ('' outside 1..7)."""
    return panel.sales_daily(spark, sf).select("Store", "Date", cal.weekday_label(F.col("DayOfWeek")).alias("weekday"))


@register("is_weekend", sql("""
SELECT Store, Date, CAST(DayOfWeek IN (6, 7) AS INTEGER) AS IsWeekend,
       CAST(isodow(Date) - 1 IN (5, 6) AS INTEGER) AS is_weekend0 FROM sales_daily""", "sales_daily"))
def is_weekend(spark, sf):
    """Weekend flag on 1-based (6,7) and 0-based (5,6) weekdays."""
    df = panel.sales_daily(spark, sf)
    return df.select("Store", "Date", cal.is_weekend(F.col("DayOfWeek")).alias("IsWeekend"),
                     cal.is_weekend(cal.day_of_week0(F.col("Date")), zero_based=True).alias("is_weekend0"))


@register("sunday_closure", sql("""
SELECT Store, max(CASE WHEN DayOfWeek = 7 THEN 1 ELSE 0 END) = 0 AS closes_on_sundays
FROM features GROUP BY Store""", "features"))
def sunday_closure(spark, sf):
    """A store closes on Sundays when its engineered history has no Sunday."""
    return _feat(spark, sf).groupBy("Store").agg(
        (F.max((F.col("DayOfWeek") == 7).cast("int")) == 0).alias("closes_on_sundays"))


# ---- synthetic product series ----------------------------------------------------------------

def _syn(spark, sf):
    return tables.synthetic_feature_table(spark, sf)


@register("residual_target", sql("""
SELECT product, date, same_day_last_week_sales, residual FROM syn_features""", "syn_features"))
def residual_target(spark, sf):
    """units_sold minus the same weekday last week (7 rows earlier)."""
    return _syn(spark, sf).select("product", "date", "same_day_last_week_sales", "residual")


@register("drop_any_null", sql("""
SELECT product, date, is_weekend, ROUND(rolling_7_day_average, 4) AS rolling_7_day_average FROM syn_features""",
                               "syn_features"))
def drop_any_null(spark, sf):
    """Synthetic features after dropping every row with a NULL."""
    return _syn(spark, sf).select("product", "date", "is_weekend", r4("rolling_7_day_average").alias(
        "rolling_7_day_average"))


def _join_str(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")


_PAST30 = "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
_NEXT7 = "ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING"


def _lst(col: str, part: str, order: str, frame: str) -> str:
    return f"array_to_string(list({col}) OVER (PARTITION BY {part} ORDER BY {order} {frame}), ',')"


@register("sliding_windows_univariate", sql(f"""
SELECT product, sample_index, past_units, target_units FROM (
  SELECT product, CAST(rp - 29 AS INTEGER) AS sample_index,
         {_lst("units_sold", "product", "date", _PAST30)} AS past_units,
         {_lst("units_sold", "product", "date", _NEXT7)} AS target_units,
         GREATEST(n - 36, 0) AS n_windows
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product ORDER BY date) - 1 AS rp,
               COUNT(*) OVER (PARTITION BY product) AS n FROM product_daily) p) x
WHERE sample_index >= 0 AND sample_index < n_windows""", "product_daily"))
def sliding_windows_univariate(spark, sf):
    """All (30 past, 7 target) windows of every product series (n-36 each)."""
    df = windows.with_positions(panel.product_daily(spark, sf), "product", "date")
    w = windows.sliding_windows(df, ["units_sold"], key="product", order="date", target="units_sold")
    return w.select("product", "sample_index", _join_str(F.col("past.units_sold")).alias("past_units"),
                    _join_str(F.col("y")).alias("target_units"))


def _z(c: str, key: str) -> str:
    w = f"OVER (PARTITION BY {key})"
    x = f"CAST({c} AS DOUBLE)"
    return (f"({x} - MIN({x}) {w}) / CASE WHEN MAX({x}) {w} - MIN({x}) {w} = 0 THEN 1.0 ELSE MAX({x}) {w} - MIN({x}) {w} END")


def _sum_sql(z: str, key: str, order: str, frame: str) -> str:
    return (f"ROUND(list_sum(list_transform(list({z}) OVER (PARTITION BY {key} ORDER BY {order} {frame}), "
            f"lambda x, i: x * sqrt(i))), 4)")


def _window_sql(past, future, target, table, key, order, extra: str = "", label: str = "") -> str:
    """Position-weighted sums of every array of every window."""
    names = list(dict.fromkeys([*past, *future, target]))
    zs = ", ".join(f"{_z(c, key)} AS z_{c}" for c in names)
    cols = [f"{_sum_sql('z_' + c, key, order, _PAST30)} AS past_{c}" for c in past]
    cols += [f"{_sum_sql('z_' + c, key, order, _NEXT7)} AS future_{c}" for c in future]
    cols.append(f"{_sum_sql(label or 'z_' + target, key, order, _NEXT7)} AS y")
    return f"""
SELECT * EXCLUDE (n_windows) FROM (
  SELECT {key}, CAST(row_position - 29 AS INTEGER) AS sample_index, {", ".join(cols)} {extra},
         CASE WHEN row_position - 29 >= CAST(floor(GREATEST(n_rows - 36, 0) * 0.8) AS INTEGER) THEN 'test' ELSE 'train' END AS split,
         GREATEST(n_rows - 36, 0) AS n_windows
  FROM (SELECT *, {zs} FROM {table}) t) x
WHERE sample_index >= 0 AND sample_index < n_windows"""


def _window_digest(blocks: DataFrame, lay: bl.Layout, extra: dict[str, str] | None = None) -> DataFrame:
    """Every window's arrays, cut from the blocks, each shown as the sum of its values times the
    roots of their 1-based places: one number that any wrong, missing or moved element of
    an array changes (and no rounding tie). ``extra``: {name: raw column}."""
    extra = extra or {}
    names = [*(f"past_{c}" for c in lay.past), *(f"future_{c}" for c in lay.future), "y", *extra]
    root = np.sqrt(np.arange(1, max(lay.wp.lookback, lay.wp.horizon) + 1))

    def digest(w: bl.Windows) -> pa.RecordBatch:
        past = np.einsum("nlf,l->fn", w.past, root[:lay.wp.lookback])
        future = np.einsum("nhf,h->fn", w.future, root[:lay.wp.horizon])
        rest = [a @ root[:lay.wp.horizon] for a in (w.y, *(w.ahead(f"raw_{c}") for c in extra.values()))]
        split = np.where(w.index >= w.row["train_size"], "test", "train")
        return pa.RecordBatch.from_arrays(
            [pa.array([w.row[lay.key]] * w.n, kind), pa.array(w.index.astype(np.int32)),
             *map(pa.array, [*past, *future, *rest]), pa.array(split.tolist())], ["key", "sample_index", *names, "split"])

    key_type = dict(blocks.dtypes)[lay.key]
    kind = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[key_type]
    out = bl.map_windows(blocks, lay, digest, f"key {key_type}, sample_index int, "
                         + ", ".join(f"`{n}` double" for n in names) + ", split string")
    return out.select(F.col("key").alias(lay.key), "sample_index", *[r4(n).alias(n) for n in names], "split")


@register("sliding_windows_two_stream", sql(_window_sql(PAST_FEATURES, FUTURE_FEATURES, "Sales", "features", "Store", "Date"),
                                            "features"))
def sliding_windows_two_stream(spark, sf):
    """All 20 past and 18 known-future features and the target of every window,
    scaled per store; each array shown as its position-weighted sum."""
    return _window_digest(bl.time_blocks(_feat(spark, sf), TWO_STREAM), TWO_STREAM)


@register("sliding_windows_two_stream_v1", sql(
    _window_sql(PAST_FEATURES_V1, FUTURE_FEATURES_V1, "Sales", "features", "Store", "Date"), "features"))
def sliding_windows_two_stream_v1(spark, sf):
    """The same with the first real feature set (9 past, 8 future)."""
    lay = bl.Layout(tuple(PAST_FEATURES_V1), tuple(FUTURE_FEATURES_V1))
    return _window_digest(bl.time_blocks(_feat(spark, sf), lay), lay)


@register("sliding_windows_synthetic", sql(_window_sql(
    SYNTHETIC_PAST, SYNTHETIC_FUTURE, "units_sold",
    "(SELECT *, ROW_NUMBER() OVER (PARTITION BY product ORDER BY date) - 1 AS row_position, "
    "COUNT(*) OVER (PARTITION BY product) AS n_rows FROM product_daily)", "product", "date"), "product_daily"))
def sliding_windows_synthetic(spark, sf):
    """Product series with 6 past and 4 known-future features (no derived features)."""
    df = windows.with_positions(panel.product_daily(spark, sf), "product", "date")
    lay = bl.Layout(tuple(SYNTHETIC_PAST), tuple(SYNTHETIC_FUTURE), "units_sold", key="product", order="date")
    return _window_digest(bl.time_blocks(df, lay), lay)


_RES_EXTRA = (", " + _sum_sql("same_day_last_week_sales", "product", "date", _NEXT7) + " AS baseline, "
              + _sum_sql("CAST(units_sold AS DOUBLE)", "product", "date", _NEXT7) + " AS actual")
_RES_LABEL = ("(SELECT *, (residual - AVG(residual) OVER (PARTITION BY product)) / CASE WHEN STDDEV_POP(residual) OVER "
              "(PARTITION BY product) = 0 THEN 1.0 ELSE STDDEV_POP(residual) OVER (PARTITION BY product) END AS z_label FROM syn_features)")


@register("sliding_windows_residual", sql(_window_sql(
    SYNTHETIC_PAST_V3, SYNTHETIC_FUTURE_V3, "units_sold", _RES_LABEL, "product", "date", _RES_EXTRA, "z_label"), "syn_features"))
def sliding_windows_residual(spark, sf):
    """The five arrays of the residual variant: 8 past and 7 future features
    (min-max), the standard-scaled residual, the weekly baseline and the actual."""
    lay = bl.Layout(tuple(SYNTHETIC_PAST_V3), tuple(SYNTHETIC_FUTURE_V3), "units_sold", key="product", order="date",
                    raw=("same_day_last_week_sales", "units_sold"), residual="residual")
    return _window_digest(bl.time_blocks(_syn(spark, sf), lay), lay, {"baseline": "same_day_last_week_sales", "actual": "units_sold"})


@register("chronological_split", sql("""
SELECT Store, sample_index, anchor_date, first_target_date,
       CASE WHEN sample_index >= train_size THEN 'test' ELSE 'train' END AS split
FROM window_index""", "window_index"))
def chronological_split(spark, sf):
    """First floor(0.8 n) windows of each store train, the rest test."""
    return windows.window_index(_feat(spark, sf)).select("Store", "sample_index", "anchor_date",
                                                         "first_target_date", "split")


@register("validation_split", sql("""
SELECT Store, sample_index,
       CASE WHEN sample_index >= train_size THEN 'test'
            WHEN sample_index >= CAST(floor(train_size * 0.8) AS INTEGER) THEN 'val' ELSE 'train' END AS split3
FROM window_index""", "window_index"))
def validation_split(spark, sf):
    """Chronological train / val (last 20% of train) / test."""
    return windows.window_index(_feat(spark, sf)).select("Store", "sample_index", "split3")


@register("sink_windows", sql(_window_sql(PAST_FEATURES, FUTURE_FEATURES, "Sales", "features", "Store", "Date"), "features"))
def sink_windows(spark, sf):
    """The arrays of all windows (past 30 x 20, future 7 x 18, y 7) written as time blocks with
    halo, each row of the table once, read back, and cut into windows."""
    back = files.materialize(spark, bl.time_blocks(_feat(spark, sf), TWO_STREAM), "windows")
    return _window_digest(back, TWO_STREAM)


@register("latest_window", sql("""
SELECT Store, Date, Sales, row_position FROM features WHERE row_position >= n_rows - 30""", "features"))
def latest_window(spark, sf):
    """The last 30 engineered rows of each store (inference context)."""
    return windows.latest_window(_feat(spark, sf)).select("Store", "Date", "Sales", "row_position")


@register("latest_state", sql("""
SELECT Store, latest_date, ROUND(last_rolling_7_sales, 4) AS last_rolling_7_sales,
       ROUND(last_rolling_14_sales, 4) AS last_rolling_14_sales,
       ROUND(last_rolling_7_std_sales, 4) AS last_rolling_7_std_sales, last_days_since_promo,
       ROUND(tail7_mean, 4) AS tail7_mean, closes_on_sundays
FROM state""", "state"))
def latest_state(spark, sf):
    """Latest date, frozen rolling values, promo counter, tail-7 mean per store."""
    st = windows.latest_state(_feat(spark, sf))
    return st.select("Store", "latest_date", *[r4(c).alias(c) for c in (
        "last_rolling_7_sales", "last_rolling_14_sales", "last_rolling_7_std_sales")],
        "last_days_since_promo", r4("tail7_mean").alias("tail7_mean"), "closes_on_sundays")


# ---- scalers ----------------------------------------------------------------------------------

def _fit_sql(features, table="features", key="Store") -> str:
    parts = [f"SELECT {key}, '{c}' AS feature, MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max "
             f"FROM {table} GROUP BY {key}" for c in features]
    return " UNION ALL ".join(parts)


@register("fit_minmax", sql("SELECT Store, feature, ROUND(min, 4) AS min, ROUND(max, 4) AS max FROM ("
                            + _fit_sql(PAST_FEATURES) + ")", "features"))
def fit_minmax(spark, sf):
    """Per store and past feature: min / max over all engineered rows."""
    p = scaling.fit_minmax(_feat(spark, sf), PAST_FEATURES)
    return p.select("Store", "feature", r4("min").alias("min"), r4("max").alias("max"))


@register("sink_scaler", sql("""
SELECT Store, feature, 'minmax' AS kind, ROUND(min, 4) AS shift,
       ROUND(CASE WHEN max - min = 0 THEN 1.0 ELSE max - min END, 4) AS scale FROM ("""
                             + _fit_sql(PAST_FEATURES) + ")", "features"))
def sink_scaler(spark, sf):
    """Scaler params (Store, feature, kind, shift, scale) written and re-read."""
    p = scaling.params_long(scaling.fit_minmax(_feat(spark, sf), PAST_FEATURES))
    back = files.materialize(spark, p, "scaler_params")
    return back.select("Store", "feature", "kind", r4("shift").alias("shift"), r4("scale").alias("scale"))


def _mm_sql(c: str) -> str:
    return _z(c, "Store")


_ALL_SCALED = "SELECT Store, Date, " + ", ".join(f"ROUND({_mm_sql(c)}, 4) AS {c}_scaled" for c in PAST_FEATURES) + " FROM features"


@register("src_scaler", sql(_ALL_SCALED, "features"))
def src_scaler(spark, sf):
    """Persisted params of all past features re-read and applied with a join on the
    store; the feature table is written once and read by both steps."""
    feat = files.materialize(spark, _feat(spark, sf).select("Store", "Date", *PAST_FEATURES), "scaler_features")
    back = files.materialize(spark, scaling.fit_minmax(feat, PAST_FEATURES), "scaler_minmax")
    out = scaling.apply_minmax(feat, back, PAST_FEATURES)
    return out.select("Store", "Date", *[r4(f"{c}_scaled").alias(f"{c}_scaled") for c in PAST_FEATURES])


@register("minmax_transform", sql(_ALL_SCALED, "features"))
def minmax_transform(spark, sf):
    """(x - min) / (max - min), divisor 1 for a constant feature, of all past
    features; fitted per store with window aggregates on the feature partitioning."""
    out = scaling.minmax_over_partition(_feat(spark, sf), PAST_FEATURES)
    return out.select("Store", "Date", *[r4(c + "_scaled").alias(c + "_scaled") for c in PAST_FEATURES])


@register("minmax_inverse", sql(f"""
SELECT Store, Date, ROUND(z * rng + lo, 4) AS Sales_restored FROM (
  SELECT Store, Date, {_mm_sql("Sales")} AS z, MIN(CAST(Sales AS DOUBLE)) OVER (PARTITION BY Store) AS lo,
         CASE WHEN MAX(Sales) OVER (PARTITION BY Store) - MIN(Sales) OVER (PARTITION BY Store) = 0 THEN 1.0
              ELSE CAST(MAX(Sales) OVER (PARTITION BY Store) - MIN(Sales) OVER (PARTITION BY Store) AS DOUBLE) END AS rng
  FROM features)""", "features"))
def minmax_inverse(spark, sf):
    """Inverse of the min-max transform (round trip restores Sales)."""
    w = Window.partitionBy("Store")
    s = F.col("Sales").cast("double")
    lo, hi = F.min(s).over(w), F.max(s).over(w)
    z = scf.minmax_transform(s, lo, hi)
    return _feat(spark, sf).select("Store", "Date", r4(scf.minmax_inverse(z, lo, hi)).alias("Sales_restored"))


@register("fit_standard", sql("""
SELECT product, ROUND(AVG(residual), 4) AS mean, ROUND(STDDEV_POP(residual), 4) AS std
FROM syn_features GROUP BY product""", "syn_features"))
def fit_standard(spark, sf):
    """Mean and population std of the residual per product."""
    p = scaling.fit_standard(_syn(spark, sf), "residual", "product")
    return p.select("product", r4("mean").alias("mean"), r4("std").alias("std"))


@register("standard_transform", sql("""
SELECT product, date, ROUND((residual - AVG(residual) OVER (PARTITION BY product))
       / CASE WHEN STDDEV_POP(residual) OVER (PARTITION BY product) = 0 THEN 1.0
              ELSE STDDEV_POP(residual) OVER (PARTITION BY product) END, 4) + 0.0 AS residual_scaled
FROM syn_features""", "syn_features"))
def standard_transform(spark, sf):
    """(x - mean) / population std per product."""
    w = Window.partitionBy("product")
    return _syn(spark, sf).select("product", "date", r4(scf.standard_transform(
        F.col("residual"), F.avg("residual").over(w), F.stddev_pop("residual").over(w))).alias("residual_scaled"))


@register("standard_inverse", sql("""
SELECT product, date, ROUND(residual, 4) AS residual_restored FROM syn_features""", "syn_features"))
def standard_inverse(spark, sf):
    """Inverse standard scaling (round trip restores the residual)."""
    w = Window.partitionBy("product")
    m, s = F.avg("residual").over(w), F.stddev_pop("residual").over(w)
    z = scf.standard_transform(F.col("residual"), m, s)
    return _syn(spark, sf).select("product", "date", r4(scf.standard_inverse(z, m, s)).alias("residual_restored"))


@register("feature_manifest", sql(" UNION ALL ".join(
    [f"SELECT 'past' AS stream, {i + 1} AS position, '{c}' AS feature, COUNT({c}) AS non_null FROM features"
     for i, c in enumerate(PAST_FEATURES)]
    + [f"SELECT 'future' AS stream, {i + 1} AS position, '{c}' AS feature, COUNT({c}) AS non_null FROM features"
       for i, c in enumerate(FUTURE_FEATURES)]), "features"))
def feature_manifest(spark, sf):
    """Past / future feature lists with their non-null counts (one aggregation)."""
    feat = _feat(spark, sf)
    names = sorted(set(PAST_FEATURES) | set(FUTURE_FEATURES))
    agg = feat.agg(*[F.count(c).alias(c) for c in names])
    rows = [F.struct(F.lit(s).alias("stream"), F.lit(i + 1).alias("position"), F.lit(c).alias("feature"),
                     F.col(c).alias("non_null"))
            for s, lst in (("past", PAST_FEATURES), ("future", FUTURE_FEATURES)) for i, c in enumerate(lst)]
    return agg.select(F.inline(F.array(*rows)))


_PAST_ONLY = [c for c in PAST_FEATURES if c not in FUTURE_FEATURES]


@register("past_only_features", sql(" UNION ALL ".join(
    f"SELECT Store, '{c}' AS feature, COUNT({c}) AS n, ROUND(MIN(CAST({c} AS DOUBLE)), 4) AS min, "
    f"ROUND(MAX(CAST({c} AS DOUBLE)), 4) AS max FROM features GROUP BY Store" for c in _PAST_ONLY), "features"))
def past_only_features(spark, sf):
    """Features of the past stream that are unknown ahead (past list minus
    future list — column names, resolved at plan time), profiled per store."""
    only = _PAST_ONLY
    feat = _feat(spark, sf)
    aggs = [a for i, c in enumerate(only) for a in (F.count(c).alias(f"n{i}"),
                                                     F.min(F.col(c).cast("double")).alias(f"lo{i}"),
                                                     F.max(F.col(c).cast("double")).alias(f"hi{i}"))]
    wide = feat.groupBy("Store").agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), r4(f"lo{i}").alias("min"),
                     r4(f"hi{i}").alias("max")) for i, c in enumerate(only)]
    return wide.select("Store", F.inline(F.array(*rows)))


_WANTED = PAST_FEATURES + ["holiday_proximity"]   # one feature the table does not have


@register("prune_missing_features", sql(" UNION ALL ".join(
    [f"SELECT '{c}' AS feature, 'kept' AS status, COUNT({c}) AS non_null FROM features" for c in PAST_FEATURES]
    + ["SELECT 'holiday_proximity' AS feature, 'dropped' AS status, CAST(0 AS BIGINT) AS non_null"]), "features"))
def prune_missing_features(spark, sf):
    """Wanted features checked against the table: missing ones are dropped
    (and reported); kept ones carry their non-null count."""
    from ..operators import clean
    feat = _feat(spark, sf)
    kept, dropped = clean.prune_missing_features(feat, _WANTED)
    agg = feat.agg(*[F.count(c).alias(c) for c in kept])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit("kept").alias("status"), F.col(c).alias("non_null"))
            for c in kept]
    rows += [F.struct(F.lit(c).alias("feature"), F.lit("dropped").alias("status"),
                      F.lit(0).cast("bigint").alias("non_null")) for c in dropped]
    return agg.select(F.inline(F.array(*rows)))
