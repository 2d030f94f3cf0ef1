"""Leakage-free time-series features over the store panel.

All features of one table share ONE window partitioning (``Store``): Spark
plans a single exchange for the whole feature step. Per-store partitions are
bounded by the calendar (one row per open day), not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..params import LAG_COLUMNS, PROMO_SENTINEL


def store_window(key: str = "Store", order: str = "Date"):
    return Window.partitionBy(key).orderBy(order)


def rolling(col: str, n: int, fn, w) -> Column:
    """``fn`` over the previous ``n`` rows (current excluded), NULL until full."""
    frame = w.rowsBetween(-n, -1)
    return F.when(F.count(col).over(frame) == n, fn(col).over(frame))


def promo_counters(df: DataFrame, key: str = "Store", order: str = "Date",
                   promo: str = "Promo", sentinel: int = PROMO_SENTINEL) -> DataFrame:
    """days_since_last_promo / days_until_next_promo in rows, closed form.

    since = rn - rn(last promo at or before), else sentinel + rn;
    until = rn(next promo at or after) - rn, else sentinel + (n - rn + 1).
    The backward scan runs FIRST on a descending order (it also yields the
    row number as n - rn_desc + 1), then everything else runs on the
    ascending order: two in-partition sorts, one shuffle, and never an
    O(n^2) unbounded-following frame.
    """
    w = Window.partitionBy(key).orderBy(order)
    wd = Window.partitionBy(key).orderBy(F.col(order).desc())
    # n over the SAME (desc) spec with a whole-partition frame: shares the desc sort
    n = F.count(F.lit(1)).over(wd.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    with_rn = df.select("*", (n - F.row_number().over(wd) + 1).alias("_rn"), n.alias("_n"))
    promo_rn = F.when(F.col(promo) == 1, F.col("_rn"))
    next_p = F.last(promo_rn, ignorenulls=True).over(wd.rowsBetween(Window.unboundedPreceding, 0))
    back = with_rn.select("*", next_p.alias("_next"))
    last_p = F.last(promo_rn, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = back.select(
        "*",
        F.coalesce(F.col("_rn") - last_p, F.lit(sentinel) + F.col("_rn")).cast("int").alias("days_since_last_promo"),
        F.coalesce(F.col("_next") - F.col("_rn"),
                   F.lit(sentinel) + F.col("_n") - F.col("_rn") + 1).cast("int").alias("days_until_next_promo"))
    return out.drop("_rn", "_n", "_next")


def engineer_features(processed: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Past features of the real pipeline (20 past / 18 future columns).

    Adds lag_7_sales, rolling_7/14_sales, rolling_7_std_sales, month edges,
    is_april, interactions, promo counters (computed BEFORE the null drop),
    sales_vs_lag7; then drops rows with incomplete lag/rolling values and
    numbers the remaining rows (``row_position``, 0-based, per store).
    """
    w = store_window()
    s = "Sales"
    feats = promo_counters(processed).select(
        "*",
        F.lag(F.col(s).cast("double"), 7).over(w).alias("lag_7_sales"),
        rolling(s, 7, F.avg, w).alias("rolling_7_sales"),
        rolling(s, 14, F.avg, w).alias("rolling_14_sales"),
        rolling(s, 7, F.stddev_samp, w).alias("rolling_7_std_sales"),
        cal.is_month_start(F.col("Date")).alias("is_month_start"),
        cal.is_month_end(F.col("Date")).alias("is_month_end"),
        cal.is_april(F.col("Month")).alias("is_april"),
        *[c.alias(n) for n, c in cal.interaction_terms(
            F.col("Promo"), F.col("SchoolHoliday"), F.col("IsWeekend")).items()],
    ).withColumn("sales_vs_lag7", F.col(s) - F.col("lag_7_sales"))
    if not drop_incomplete:
        return feats
    kept = feats.dropna(subset=LAG_COLUMNS)
    return kept.select("*", (F.row_number().over(w) - 1).alias("row_position"),
                       F.count(F.lit(1)).over(Window.partitionBy("Store")).alias("n_rows"))


def synthetic_features(product: DataFrame) -> DataFrame:
    """Features of the synthetic product pipeline (v3 / residual variants):
    is_weekend (0-based days), rolling_7_day_average, same_day_last_week_sales,
    residual; rows with nulls dropped; ``row_position`` per product."""
    w = store_window("product", "date")
    f = product.select(
        "*",
        cal.is_weekend(F.col("day_of_week"), zero_based=True).alias("is_weekend"),
        rolling("units_sold", 7, F.avg, w).alias("rolling_7_day_average"),
        F.lag(F.col("units_sold").cast("double"), 7).over(w).alias("same_day_last_week_sales"),
    ).withColumn("residual", F.col("units_sold") - F.col("same_day_last_week_sales"))
    kept = f.dropna("any")
    return kept.select("*", (F.row_number().over(w) - 1).alias("row_position"),
                       F.count(F.lit(1)).over(Window.partitionBy("product")).alias("n_rows"))
