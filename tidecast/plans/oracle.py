"""DuckDB oracle SQL: the same computations written as plain SQL over the
pre-registered testdata views. ``sql(final, needs)`` prepends the CTE chain
a query depends on (transitively, in dependency order)."""

from __future__ import annotations

from ..params import LinearPlan

_W = "PARTITION BY Store ORDER BY Date"


def _frame(lo: int, hi: int) -> str:
    return f"({_W} ROWS BETWEEN {lo} PRECEDING AND {hi} PRECEDING)"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("sales_daily", [], """
SELECT Store, Date, CAST(isodow(Date) AS INTEGER) AS DayOfWeek,
       CAST(CASE WHEN isodow(Date) = 7 AND Store % 4 <> 3 THEN 0 ELSE qty END AS BIGINT) AS Sales,
       Customers,
       CAST(CASE WHEN isodow(Date) = 7 AND Store % 4 <> 3 THEN 0 ELSE 1 END AS INTEGER) AS Open,
       Promo,
       CASE WHEN month(Date) = 12 AND day(Date) IN (25, 26) THEN 'c' ELSE '0' END AS StateHoliday,
       CAST(CASE WHEN month(Date) IN (7, 8) THEN 1 ELSE 0 END AS INTEGER) AS SchoolHoliday
FROM (SELECT s_nationkey AS Store, CAST(l_shipdate AS DATE) AS Date,
             SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(DISTINCT l_orderkey) AS Customers,
             CAST(MAX(CASE WHEN l_discount >= 0.095 THEN 1 ELSE 0 END) AS INTEGER) AS Promo
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
      GROUP BY 1, 2)""")

cte("store_dim", [], """
SELECT n_nationkey AS Store,
       CASE n_nationkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'd' END AS StoreType,
       CASE n_nationkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS Assortment,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(100 * (n_nationkey + 1) AS DOUBLE) END AS CompetitionDistance,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey % 12 + 1 END AS CompetitionOpenSinceMonth,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 1990 + n_nationkey END AS CompetitionOpenSinceYear,
       n_nationkey % 2 AS Promo2,
       CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE n_nationkey + 1 END AS Promo2SinceWeek,
       CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE 1995 END AS Promo2SinceYear
FROM nation""")

cte("merged", ["sales_daily", "store_dim"], """
SELECT s.*, d.StoreType, d.Assortment, d.CompetitionDistance, d.CompetitionOpenSinceMonth,
       d.CompetitionOpenSinceYear, d.Promo2, d.Promo2SinceWeek, d.Promo2SinceYear
FROM sales_daily s LEFT JOIN store_dim d ON s.Store = d.Store""")


def _onehot(col: str, values: list[str]) -> str:
    return ",\n       ".join(f"CAST(COALESCE(m.{col} = '{v}', false) AS INTEGER) AS {col}_{v}" for v in values)


cte("processed", ["merged", "store_dim"], f"""
SELECT m.Date, m.Store, m.DayOfWeek, m.Sales, m.Open, m.Promo, m.SchoolHoliday,
       COALESCE(m.CompetitionDistance, (SELECT median(CompetitionDistance) FROM store_dim)) AS CompetitionDistance,
       COALESCE(m.CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
       COALESCE(m.CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear,
       m.Promo2,
       COALESCE(m.Promo2SinceWeek, 0) AS Promo2SinceWeek,
       COALESCE(m.Promo2SinceYear, 0) AS Promo2SinceYear,
       {_onehot("StateHoliday", ["0", "a", "b", "c"])},
       {_onehot("StoreType", ["a", "b", "c", "d"])},
       {_onehot("Assortment", ["a", "b", "c"])},
       CAST(month(m.Date) AS INTEGER) AS Month, CAST(year(m.Date) AS INTEGER) AS Year,
       CAST(day(m.Date) AS INTEGER) AS Day,
       CAST(CASE WHEN m.DayOfWeek IN (6, 7) THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend
FROM merged m WHERE m.Open = 1""")

cte("feat_base", ["processed"], f"""
SELECT p.*, CAST(ROW_NUMBER() OVER ({_W}) AS INTEGER) AS rn, COUNT(*) OVER (PARTITION BY Store) AS n_all
FROM processed p""")

cte("feat_all", ["feat_base"], f"""
SELECT b.*,
       CAST(LAG(Sales, 7) OVER ({_W}) AS DOUBLE) AS lag_7_sales,
       CASE WHEN COUNT(Sales) OVER {_frame(7, 1)} = 7 THEN AVG(Sales) OVER {_frame(7, 1)} END AS rolling_7_sales,
       CASE WHEN COUNT(Sales) OVER {_frame(14, 1)} = 14 THEN AVG(Sales) OVER {_frame(14, 1)} END AS rolling_14_sales,
       CASE WHEN COUNT(Sales) OVER {_frame(7, 1)} = 7 THEN STDDEV_SAMP(Sales) OVER {_frame(7, 1)} END AS rolling_7_std_sales,
       CAST(COALESCE(rn - MAX(CASE WHEN Promo = 1 THEN rn END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     9999 + rn) AS INTEGER) AS days_since_last_promo,
       CAST(COALESCE(MIN(CASE WHEN Promo = 1 THEN rn END) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - rn,
                     9999 + n_all - rn + 1) AS INTEGER) AS days_until_next_promo,
       CAST(day(Date) = 1 AS INTEGER) AS is_month_start,
       CAST(Date = last_day(Date) AS INTEGER) AS is_month_end,
       CAST(Month = 4 AS INTEGER) AS is_april,
       Promo * SchoolHoliday AS promo_schoolholiday,
       IsWeekend * SchoolHoliday AS weekend_schoolholiday,
       Promo * IsWeekend AS promo_weekend
FROM feat_base b""")

cte("features", ["feat_all"], f"""
SELECT k.*, CAST(ROW_NUMBER() OVER ({_W}) - 1 AS INTEGER) AS row_position,
       COUNT(*) OVER (PARTITION BY Store) AS n_rows
FROM (SELECT a.* EXCLUDE (rn, n_all), Sales - lag_7_sales AS sales_vs_lag7 FROM feat_all a
      WHERE lag_7_sales IS NOT NULL AND rolling_7_sales IS NOT NULL AND rolling_14_sales IS NOT NULL
        AND rolling_7_std_sales IS NOT NULL AND Sales - lag_7_sales IS NOT NULL) k""")

_LAGS = ", ".join(f"CAST(LAG(Sales, {d}) OVER ({_W}) AS DOUBLE)" for d in range(1, 8))

cte("horizon_base", ["features"], f"""
SELECT Store, Date AS target_date, row_position, CAST(Sales AS DOUBLE) AS actual_sales,
       CAST(LAG(Sales, 7) OVER ({_W}) AS DOUBLE) AS weekly_seasonal, [{_LAGS}] AS lags,
       CAST(GREATEST(n_rows - 36, 0) AS INTEGER) AS n_windows,
       Promo, SchoolHoliday, DayOfWeek, Month, Day, IsWeekend, is_month_start, is_month_end, is_april,
       promo_schoolholiday, weekend_schoolholiday, promo_weekend, days_since_last_promo, days_until_next_promo
FROM features""")

cte("horizon", ["horizon_base"], """
SELECT Store, CAST(row_position - d.forecast_day - 29 AS INTEGER) AS sample_index,
       CAST(d.forecast_day AS INTEGER) AS forecast_day, target_date, row_position AS target_row,
       actual_sales, lags[d.forecast_day] AS last_value, weekly_seasonal,
       CASE WHEN row_position - d.forecast_day - 29 >= CAST(floor(n_windows * 0.8) AS INTEGER) THEN 'test' ELSE 'train' END AS split,
       CASE WHEN row_position - d.forecast_day - 29 >= CAST(floor(n_windows * 0.8) AS INTEGER) THEN 'test'
            WHEN row_position - d.forecast_day - 29 >= CAST(floor(CAST(floor(n_windows * 0.8) AS INTEGER) * 0.8) AS INTEGER) THEN 'val'
            ELSE 'train' END AS split3,
       CAST(floor(n_windows * 0.8) AS INTEGER) AS train_size,
       Promo, SchoolHoliday, DayOfWeek, Month, Day, IsWeekend, is_month_start, is_month_end, is_april,
       promo_schoolholiday, weekend_schoolholiday, promo_weekend, days_since_last_promo, days_until_next_promo
FROM horizon_base CROSS JOIN range(1, 8) d(forecast_day)
WHERE row_position - d.forecast_day - 29 >= 0 AND row_position - d.forecast_day - 29 < n_windows""")

cte("window_index", ["features"], f"""
SELECT * FROM (
  SELECT Store, Date AS anchor_date, LEAD(Date, 1) OVER ({_W}) AS first_target_date,
         CAST(row_position - 29 AS INTEGER) AS sample_index,
         CAST(GREATEST(n_rows - 36, 0) AS INTEGER) AS n_windows,
         CAST(floor(GREATEST(n_rows - 36, 0) * 0.8) AS INTEGER) AS train_size
  FROM features) x
WHERE sample_index >= 0 AND sample_index < n_windows""")


def _pred(method_expr: str, policy: str = "mask") -> str:
    pe = {"mask": "CASE WHEN actual_sales <> 0 THEN abs(actual_sales - p) / abs(actual_sales) * 100 END",
          "epsilon": "abs(actual_sales - p) / (abs(actual_sales) + 1e-8) * 100"}[policy]
    return f"""
SELECT Store, sample_index, CAST(sample_index - train_size AS INTEGER) AS test_index, forecast_day, target_date,
       actual_sales, p AS predicted_sales, abs(actual_sales - p) AS absolute_error, {pe} AS percentage_error
FROM (SELECT *, {method_expr} AS p FROM horizon WHERE split = 'test') t"""


cte("preds_weekly", ["horizon"], _pred("weekly_seasonal"))
cte("preds_last", ["horizon"], _pred("last_value"))

cte("methods_long", ["horizon"], """
SELECT Store, sample_index, forecast_day, target_date, actual_sales, 'last_value' AS method, last_value AS predicted_sales
FROM horizon WHERE split = 'test'
UNION ALL
SELECT Store, sample_index, forecast_day, target_date, actual_sales, 'weekly_seasonal' AS method, weekly_seasonal
FROM horizon WHERE split = 'test'""")

cte("method_metrics", ["methods_long"], """
SELECT Store, method, avg(abs(actual_sales - predicted_sales)) AS mae,
       sqrt(avg((actual_sales - predicted_sales) * (actual_sales - predicted_sales))) AS rmse,
       avg(CASE WHEN actual_sales <> 0 THEN abs(actual_sales - predicted_sales) / abs(actual_sales) * 100 END) AS mape,
       count(*) AS n_points
FROM methods_long GROUP BY Store, method""")

cte("context", ["preds_weekly", "features"], """
SELECT p.*, f.Date, f.DayOfWeek, f.Month, f.Day, f.Promo, f.SchoolHoliday, f.IsWeekend, f.Sales,
       f.lag_7_sales, f.rolling_7_sales
FROM preds_weekly p LEFT JOIN features f
  ON p.Store = f.Store AND f.row_position = p.sample_index + 30 + p.forecast_day - 1""")

# --- synthetic product pipeline ---------------------------------------------------------------
cte("product_daily", [], """
SELECT date, product, units_sold, CAST(_cents // units_sold AS DOUBLE) / 100.0 AS price, stock, promotion,
       CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month
FROM (SELECT CAST(l_shipdate AS DATE) AS date, p_type AS product,
             CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
             CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS _cents,
             CAST(SUM(CAST(p_size AS BIGINT)) AS BIGINT) AS stock,
             CAST(MAX(CASE WHEN l_discount >= 0.095 THEN 1 ELSE 0 END) AS INTEGER) AS promotion
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""")

_PW = "PARTITION BY product ORDER BY date"

cte("syn_all", ["product_daily"], f"""
SELECT p.*, CAST(CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
       CASE WHEN COUNT(units_sold) OVER ({_PW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) = 7
            THEN AVG(units_sold) OVER ({_PW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) END AS rolling_7_day_average,
       CAST(LAG(units_sold, 7) OVER ({_PW}) AS DOUBLE) AS same_day_last_week_sales
FROM product_daily p""")

cte("syn_features", ["syn_all"], f"""
SELECT k.*, CAST(ROW_NUMBER() OVER ({_PW}) - 1 AS INTEGER) AS row_position,
       COUNT(*) OVER (PARTITION BY product) AS n_rows
FROM (SELECT a.*, units_sold - same_day_last_week_sales AS residual FROM syn_all a
      WHERE rolling_7_day_average IS NOT NULL AND same_day_last_week_sales IS NOT NULL) k""")

_PLAGS = ", ".join(f"CAST(LAG(units_sold, {d}) OVER ({_PW}) AS DOUBLE)" for d in range(1, 8))

cte("syn_horizon", ["syn_features"], f"""
SELECT product, CAST(row_position - d.forecast_day - 29 AS INTEGER) AS sample_index,
       CAST(d.forecast_day AS INTEGER) AS forecast_day, date AS target_date, actual_sales,
       lags[d.forecast_day] AS last_value, weekly_seasonal, residual, n_windows,
       CASE WHEN row_position - d.forecast_day - 29 >= CAST(floor(n_windows * 0.8) AS INTEGER)
            THEN 'test' ELSE 'train' END AS split
FROM (SELECT product, date, row_position, CAST(units_sold AS DOUBLE) AS actual_sales,
             CAST(LAG(units_sold, 7) OVER ({_PW}) AS DOUBLE) AS weekly_seasonal, residual,
             [{_PLAGS}] AS lags, CAST(GREATEST(n_rows - 36, 0) AS INTEGER) AS n_windows FROM syn_features) b
CROSS JOIN range(1, 8) d(forecast_day)
WHERE row_position - d.forecast_day - 29 >= 0 AND row_position - d.forecast_day - 29 < n_windows""")

# --- forecasting state ------------------------------------------------------------------------
cte("state", ["features"], """
SELECT Store, max(Date) AS latest_date,
       max(CASE WHEN row_position = n_rows - 1 THEN rolling_7_sales END) AS last_rolling_7_sales,
       max(CASE WHEN row_position = n_rows - 1 THEN rolling_14_sales END) AS last_rolling_14_sales,
       max(CASE WHEN row_position = n_rows - 1 THEN rolling_7_std_sales END) AS last_rolling_7_std_sales,
       max(CASE WHEN row_position = n_rows - 1 THEN days_since_last_promo END) AS last_days_since_promo,
       avg(CASE WHEN row_position >= n_rows - 7 THEN Sales END) AS tail7_mean,
       max(CASE WHEN DayOfWeek = 7 THEN 1 ELSE 0 END) = 0 AS closes_on_sundays
FROM features GROUP BY Store""")

cte("future_dates_cal", ["state"], """
SELECT s.*, CAST(s.latest_date + INTERVAL (k.k) DAY AS DATE) AS date, CAST(k.k AS INTEGER) AS step
FROM state s CROSS JOIN range(1, 8) k(k)""")

# Future dates: the first 7 non-skipped days after the latest date.
cte("future_dates", ["state"], """
SELECT * FROM (
  SELECT s.*, CAST(s.latest_date + INTERVAL (k.k) DAY AS DATE) AS date,
         CAST(ROW_NUMBER() OVER (PARTITION BY s.Store ORDER BY k.k) AS INTEGER) AS step
  FROM state s CROSS JOIN range(1, 16) k(k)
  WHERE NOT (s.closes_on_sundays AND isodow(CAST(s.latest_date + INTERVAL (k.k) DAY AS DATE)) = 7)) x
WHERE step <= 7""")


def sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order) + "\n" + final.strip()


_PLAN = LinearPlan()


def _future_pred(src: str, promo: str = "0", school: str = "0") -> str:
    """Future days with the linear model; ``promo`` / ``school``: the day's planned flags."""
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return f"""
SELECT *, CASE WHEN open = 0 THEN 0.0 ELSE GREATEST(linear, 0.0) END AS raw_prediction,
       CAST(round_even(CASE WHEN open = 0 THEN 0.0 ELSE GREATEST(linear, 0.0) END, 0) AS BIGINT) AS predicted_sales
FROM (SELECT *, lag_7_sales * {d(_PLAN.lag)} + last_rolling_7_sales * {d(_PLAN.rolling)}
                + last_rolling_7_sales * {d(_PLAN.promo)} * promo_flag
                + last_rolling_7_sales * {d(_PLAN.school_holiday)} * school_flag
                + last_rolling_7_sales * {d(_PLAN.promo_weekend)} * promo_flag * CAST(day_of_week IN (6, 7) AS INTEGER) AS linear
FROM (SELECT fd.*, CAST(isodow(fd.date) AS INTEGER) AS day_of_week,
       CAST(CASE WHEN fd.closes_on_sundays AND isodow(fd.date) = 7 THEN 0 ELSE 1 END AS INTEGER) AS open,
       COALESCE(CAST(h.Sales AS DOUBLE), fd.tail7_mean) AS lag_7_sales,
       CAST({promo} AS INTEGER) AS promo_flag, CAST({school} AS INTEGER) AS school_flag
FROM {src} fd LEFT JOIN features h ON h.Store = fd.Store AND h.Date = fd.date - 7))"""


cte("future_pred", ["future_dates", "features"], _future_pred("future_dates"))
cte("future_pred_cal", ["future_dates_cal", "features"], _future_pred("future_dates_cal"))

cte("scenarios", [], """
SELECT position, name, promo, CAST(stock AS BIGINT) AS current_stock, CAST(price AS DOUBLE) AS unit_price,
       CAST(lead AS INTEGER) AS reorder_lead_time_days, CAST(safety AS DOUBLE) AS safety_stock_percentage
FROM (VALUES (0, 'Normal', false, 300, 12.5, 3, 0.15), (1, 'Promo', true, 300, 10.0, 3, 0.15),
             (2, 'Lean', false, 50, 12.5, 7, 0.30), (3, 'NoStock', false, NULL, NULL, 3, 0.15),
             (4, 'Twin of Normal', false, 300, 12.5, 3, 0.15)) v(position, name, promo, stock, price, lead, safety)""")

cte("scen_future", ["future_dates", "features", "scenarios"], _future_pred(
    "(SELECT f.*, s.position, s.promo AS promoted FROM future_dates f CROSS JOIN scenarios s)", "fd.promoted AND fd.step <= 2"))

cte("scen_ins0", ["scen_future", "scenarios"], """
SELECT t.Store, s.*, t.total, t.n,
       CAST(round_even(CAST(t.total AS DOUBLE) / t.n, 0) AS BIGINT) AS avg_ins,
       CAST(t.total AS DOUBLE) * s.unit_price AS expected_revenue,
       s.current_stock - t.total AS projected,
       CASE WHEN s.current_stock IS NOT NULL THEN CAST(t.total AS DOUBLE) * s.safety_stock_percentage END AS safety_stock
FROM (SELECT Store, position, CAST(SUM(predicted_sales) AS BIGINT) AS total, COUNT(*) AS n FROM scen_future GROUP BY 1, 2) t
JOIN scenarios s ON s.position = t.position""")

cte("scen_ins", ["scen_ins0"], """
SELECT *, CASE WHEN current_stock IS NULL THEN NULL WHEN projected < 0 THEN 'high'
               WHEN current_stock <= reorder_point THEN 'medium' ELSE 'low' END AS risk,
       CASE WHEN current_stock IS NULL THEN NULL
            WHEN projected < 0 OR current_stock <= reorder_point THEN true ELSE false END AS needed,
       CASE WHEN current_stock IS NULL THEN NULL
            WHEN projected < 0 OR current_stock <= reorder_point
            THEN GREATEST(0, CAST(round_even(CAST(total AS DOUBLE) + safety_stock - current_stock, 0) AS BIGINT))
            ELSE 0 END AS qty
FROM (SELECT *, CASE WHEN current_stock IS NOT NULL THEN avg_ins * reorder_lead_time_days + safety_stock END AS reorder_point
      FROM scen_ins0)""")

cte("scen_score", ["scen_ins"], """
SELECT *, current_stock IS NOT NULL AS has_stock,
       CASE WHEN current_stock IS NOT NULL THEN
            CAST(CASE lower(COALESCE(risk, 'high')) WHEN 'low' THEN 100 WHEN 'medium' THEN 50 ELSE 0 END AS DOUBLE)
            + CASE WHEN NOT COALESCE(needed, true) THEN 200.0 ELSE 0.0 END
            + CAST(COALESCE(projected, 0) AS DOUBLE) * 0.01 - CAST(COALESCE(qty, 0) AS DOUBLE) * 0.05
       ELSE CAST(COALESCE(total, 0) AS DOUBLE) END AS score
FROM scen_ins""")
