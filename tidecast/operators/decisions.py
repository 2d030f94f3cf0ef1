"""Inventory decisions (business insights) and what-if scenario ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import (REASON_SALES, REASON_STOCK, RISK_SCORE, TEXT_HIGH, TEXT_LOW, TEXT_MEDIUM,
                      TEXT_NO_STOCK, TEXT_REPORT_REORDER, TEXT_REPORT_SUFFICIENT)


def insight_columns(total: Column, n_days: Column, stock: Column, price: Column,
                    lead: Column, safety_pct: Column) -> dict[str, Column]:
    """The business-insight rules as column expressions (NULL-propagating)."""
    total_d = total.cast("double")
    avg = F.when(n_days > 0, F.bround(total_d / n_days, 0)).otherwise(F.lit(0.0)).cast("bigint")
    revenue = total_d * price
    has_stock = stock.isNotNull()
    projected = stock - total
    safety = total_d * safety_pct
    reorder_point = avg * lead + safety
    risk = (F.when(~has_stock, F.lit(None).cast("string"))
            .when(projected < 0, "high")
            .when(stock <= reorder_point, "medium")
            .otherwise("low"))
    needed = F.when(has_stock, risk != "low")
    qty = F.when(~has_stock, F.lit(None).cast("bigint")).when(
        needed, F.greatest(F.lit(0).cast("bigint"),
                           F.bround(total_d + safety - stock, 0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
    text = (F.when(~has_stock, TEXT_NO_STOCK).when(risk == "high", TEXT_HIGH)
            .when(risk == "medium", TEXT_MEDIUM).otherwise(TEXT_LOW))
    return {
        "total_predicted_sales": total.cast("bigint"),
        "average_predicted_sales": avg,
        "expected_revenue": revenue,
        "current_stock": stock,
        "projected_stock_after_7_days": projected.cast("bigint"),
        "safety_stock": F.when(has_stock, safety),
        "reorder_point": F.when(has_stock, reorder_point),
        "stockout_risk": risk,
        "recommended_reorder_quantity": qty,
        "reorder_needed": needed,
        "recommendation": text,
    }


def with_insights(fc: DataFrame) -> DataFrame:
    """Adds the insight columns to a forecast table (one row per store x request)."""
    cols = insight_columns(F.col("total_predicted_sales"), F.size("days"), F.col("current_stock"),
                           F.col("unit_price"), F.col("reorder_lead_time_days"), F.col("safety_stock_percentage"))
    keep = [c for c in fc.columns if c not in cols]
    return fc.select(*keep, *[c.alias(n) for n, c in cols.items()])


INSIGHT_FIELDS = ["total_predicted_sales", "average_predicted_sales", "expected_revenue", "current_stock",
                  "projected_stock_after_7_days", "stockout_risk", "recommended_reorder_quantity",
                  "reorder_needed", "recommendation"]


def insights_struct() -> Column:
    return F.struct(*[F.col(c) for c in INSIGHT_FIELDS])


def report_recommendation(text: Column, reorder_needed: Column, qty: Column) -> Column:
    """The report's text: the service recommendation, else a fallback by the
    reorder flag (empty text counts as missing)."""
    head, tail = TEXT_REPORT_REORDER.split("{qty}")
    fallback = F.when(F.coalesce(reorder_needed, F.lit(False)),
                      F.concat(F.lit(head), F.coalesce(qty.cast("string"), F.lit("")), F.lit(tail))) \
                .otherwise(F.lit(TEXT_REPORT_SUFFICIENT))
    return F.when(F.coalesce(F.length(text), F.lit(0)) > 0, text).otherwise(fallback)


def alias_coalesce(df: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    """Accept several spellings of one field: first present non-null wins."""
    present = [F.col(n) for n in names if n in df.columns]
    return df.withColumn(out, F.coalesce(*present) if present else F.lit(None))


def scenario_score(risk: Column, reorder_needed: Column, projected: Column, qty: Column,
                   stock: Column, total: Column) -> Column:
    """With stock: risk points (missing risk = high) + 200 when no reorder
    (missing flag = reorder) + 0.01 projected - 0.05 qty; without: total sales."""
    risk_pts = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in RISK_SCORE.items()
                                                      for x in (F.lit(k), F.lit(v))]),
                                       F.lower(F.coalesce(risk, F.lit("high")))), F.lit(0))
    with_stock = (risk_pts.cast("double")
                  + F.when(~F.coalesce(reorder_needed, F.lit(True)), F.lit(200.0)).otherwise(F.lit(0.0))
                  + F.coalesce(projected, F.lit(0)) * 0.01
                  - F.coalesce(qty, F.lit(0)) * 0.05)
    return F.when(stock.isNotNull(), with_stock).otherwise(F.coalesce(total, F.lit(0)).cast("double"))


def score_scenarios(ins: DataFrame) -> DataFrame:
    return ins.withColumn("score", scenario_score(
        F.col("stockout_risk"), F.col("reorder_needed"), F.col("projected_stock_after_7_days"),
        F.col("recommended_reorder_quantity"), F.col("current_stock"), F.col("total_predicted_sales"))) \
        .withColumn("has_stock", F.col("current_stock").isNotNull())


def best_scenario(scored: DataFrame, by: Sequence[str] = ("Store",)) -> DataFrame:
    """Highest score per comparison; the first scenario (lowest position) wins
    ties. ``comparable`` is false when stocked and stock-less scenarios mix."""
    pick = F.max_by(F.struct("name", "position", "has_stock", "score"),
                    F.struct(F.col("score"), -F.col("position")))
    g = scored.groupBy(*by).agg(pick.alias("_b"), F.count(F.lit(1)).alias("scenario_count"),
                                F.min(F.col("has_stock").cast("int")).alias("_mn"),
                                F.max(F.col("has_stock").cast("int")).alias("_mx"))
    return g.select(*by, "scenario_count",
                    F.col("_b.name").alias("best_scenario"), F.col("_b.position").alias("best_position"),
                    F.col("_b.score").alias("best_score"),
                    F.when(F.col("_b.has_stock"), REASON_STOCK).otherwise(REASON_SALES).alias("reason"),
                    (F.col("_mn") == F.col("_mx")).alias("comparable"))
