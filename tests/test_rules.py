"""Rule tables with boundary cases: insights, scenario score and ties, validation."""

from pyspark.sql import functions as F

from tidecast.operators import decisions as dc
from tidecast.operators import validate as vd
from tidecast.params import REASON_SALES, REASON_STOCK


def _ins(spark, rows):
    df = spark.createDataFrame(rows, "total long, n int, stock long, price double, lead int, safety double")
    cols = dc.insight_columns(F.col("total"), F.col("n"), F.col("stock"), F.col("price"), F.col("lead"),
                              F.col("safety"))
    return df.select(*[c.alias(k) for k, c in cols.items()]).collect()


def test_insight_boundaries(spark):
    rows = _ins(spark, [
        (700, 7, 700, 2.0, 3, 0.0),     # projected = 0 -> not high; stock 700 > rp 300 -> low
        (70, 7, 70, None, 7, 0.0),      # projected 0 and stock == reorder point (10*7) -> medium
        (700, 7, None, None, 3, 0.15),  # no stock -> all stock outputs NULL
        (350, 7, 300, 1.0, 3, 0.15),    # 350+52.5-300 = 102.5 -> half-even 102
        (10, 4, 100, 1.0, 1, 0.0),      # avg 2.5 -> half-even 2
        (0, 0, 5, 1.0, 3, 0.15),        # empty forecast -> avg 0
    ])
    assert (rows[0].stockout_risk, rows[0].reorder_needed, rows[0].recommended_reorder_quantity) == ("low", False, 0)
    assert rows[0].projected_stock_after_7_days == 0
    assert (rows[1].stockout_risk, rows[1].reorder_needed) == ("medium", True)
    assert rows[1].expected_revenue is None
    r = rows[2]
    assert (r.stockout_risk, r.reorder_needed, r.recommended_reorder_quantity, r.projected_stock_after_7_days) == \
        (None, None, None, None)
    assert r.recommendation.startswith("Forecast generated successfully.")
    assert rows[3].recommended_reorder_quantity == 102 and rows[3].stockout_risk == "high"
    assert rows[4].average_predicted_sales == 2
    assert rows[5].average_predicted_sales == 0


def test_scenario_score_and_first_wins(spark):
    df = spark.createDataFrame([
        (1, 0, "A", "low", False, 10, 0, 300, 500),
        (1, 1, "B", "low", False, 10, 0, 300, 500),      # exact tie with A -> A wins
        (1, 2, "C", "high", True, -50, 60, 10, 500),
        (2, 0, "X", None, None, None, None, None, 400),  # no stock -> score = total
        (2, 1, "Y", None, None, None, None, None, 450),
    ], "Store int, position int, name string, stockout_risk string, reorder_needed boolean, "
       "projected_stock_after_7_days long, recommended_reorder_quantity long, current_stock long, "
       "total_predicted_sales long")
    s = dc.score_scenarios(df)
    scores = {(r.Store, r.position): r.score for r in s.collect()}
    assert scores[(1, 0)] == 100 + 200 + 0.1
    assert abs(scores[(1, 2)] - (0 - 0.5 - 3.0)) < 1e-9
    assert scores[(2, 1)] == 450.0
    best = {r.Store: r for r in dc.best_scenario(s).collect()}
    assert (best[1].best_scenario, best[1].reason, best[1].comparable) == ("A", REASON_STOCK, True)
    assert (best[2].best_scenario, best[2].reason) == ("Y", REASON_SALES)


def test_report_recommendation_fallback(spark):
    df = spark.createDataFrame([(None, True, 12), ("", False, 0), ("text", True, 1)],
                               "t string, needed boolean, qty long")
    got = [r.x for r in df.select(dc.report_recommendation(F.col("t"), F.col("needed"), F.col("qty")).alias("x"))
           .collect()]
    assert got == ["Reorder immediately. Recommended quantity: 12 units.",
                   "Stock levels are sufficient for this period.", "text"]


def test_request_rules(spark):
    rows = [
        (7, ["2015-08-01"], 0, 0.0, 1, 0.0),
        (14, [], None, None, 30, 1.0),
        (None, ["2015/08/01"], -1, -0.5, 0, 1.5),
        (7, ["2015-02-30", "2015-8-1"], None, None, 31, None),
    ]
    df = spark.createDataFrame(rows, "forecast_days int, promo_dates array<string>, current_stock long, "
                                     "unit_price double, reorder_lead_time_days int, safety_stock_percentage double")
    df = df.withColumn("school_holiday_dates", F.array().cast("array<string>"))
    got = [r.errors for r in vd.validate_requests(df).collect()]
    assert got[0] == []
    assert got[1] == ["forecast_days"]
    assert got[2] == ["forecast_days", "promo_dates", "current_stock", "unit_price", "reorder_lead_time_days",
                      "safety_stock_percentage"]
    assert got[3] == ["promo_dates", "reorder_lead_time_days"]


def test_contract_fails_fast(spark):
    import pytest

    from tidecast import schemas
    from tidecast.sources import files
    good = spark.createDataFrame([], schemas.SALES_DAILY)
    assert files.require_contract(good, "sales", schemas.SALES_DAILY) is good
    bad = good.drop("Promo").withColumn("Sales", F.col("Sales").cast("string"))
    with pytest.raises(files.ContractError, match=r"missing \['Promo'\].*Sales: string != bigint"):
        files.require_contract(bad, "sales", schemas.SALES_DAILY)
