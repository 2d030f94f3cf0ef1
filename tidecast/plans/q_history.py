"""Queries: request validation (2.2), forecast history (2.11), JSON
helpers (2.8) and report exports (2.1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..operators import decisions as dc
from ..operators import forecast as fc
from ..operators import history as hs
from ..operators import validate as vd
from ..operators import versions
from ..session import scratch_path
from ..sources import files, reports
from . import tables
from . import requests as rq
from .oracle import _future_pred, cte, sql
from .registry import register


def _state(spark, sf):
    return fc.history_state(tables.feature_table(spark, sf))


def _text_rows(texts) -> str:
    return ", ".join("({}, '{}')".format(i, t.replace("'", "''")) for i, t in enumerate(texts))


_NUM_RE = "[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?"


_SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


def _field(f: str, rule: str, kind: str) -> tuple[str, str]:
    """DuckDB: (typed value, wrong type) of a JSON field of the object ``j``."""
    t, x = f"json_type(j, '$.{f}')", f"(j ->> '$.{f}')"
    if rule == "text":
        ok, value = f"{t} = 'VARCHAR'", x
    elif rule == "dates":
        ok = f"{t} = 'ARRAY'"
        value = f"CASE WHEN {ok} THEN list_transform(json_extract(j, '$.{f}[*]'), lambda e: e ->> '$') END"
    elif rule == "boolean":
        ok = f"(({t} = 'BOOLEAN') OR ({t} IN ('UBIGINT', 'VARCHAR') AND {x} IN ('0', '1')))"
        value = f"({x} IN ('true', '1'))"
    elif rule == "integer":
        digits = f"regexp_extract({x}, '^([+-]?[0-9]{{1,19}})(\\.0*)?$', 1)"
        value = f"CASE WHEN {digits} <> '' THEN TRY_CAST({digits} AS {_SQL_TYPE[kind]}) ELSE TRY_CAST(TRY_CAST({x} AS DOUBLE) AS {_SQL_TYPE[kind]}) END"
        ok = (f"((({t} IN ('UBIGINT', 'BIGINT', 'VARCHAR') AND regexp_full_match({x}, '[+-]?[0-9]{{1,19}}')) "
              f"OR ({t} = 'DOUBLE' AND TRY_CAST({x} AS DOUBLE) = floor(TRY_CAST({x} AS DOUBLE)))) AND {value} IS NOT NULL)")
    else:
        ok = f"({t} IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'VARCHAR') AND regexp_full_match({x}, '{_NUM_RE}'))"
        value = f"TRY_CAST({x} AS DOUBLE)"
    null = "false" if f in vd.NULLABLE else "true"
    cast = _SQL_TYPE.get(kind)
    value = f"CASE WHEN {t} <> 'NULL' AND {ok} THEN {value} END"
    return (f"CAST({value} AS {cast})" if cast else value), f"CASE WHEN {t} IS NULL THEN false WHEN {t} = 'NULL' THEN {null} ELSE NOT {ok} END"


_TYPED = ", ".join(f"{_field(f, *spec)[0]} AS {f}, {_field(f, *spec)[1]} AS bad_{f}" for f, spec in vd.FIELDS.items())

cte("req_bodies", ["state"], f"""
SELECT s.Store, CAST(s.Store AS BIGINT) * 100 + v.variant AS request_id, v.variant, s.latest_date,
       replace(v.body, '{{d1}}', strftime(s.latest_date + 1, '%Y-%m-%d')) AS body
FROM state s CROSS JOIN (VALUES {_text_rows(rq.REQUEST_VARIANTS)}) v(variant, body)""")

cte("req_variants", ["req_bodies"], f"""
SELECT *, {_TYPED} FROM (
  SELECT *, CASE WHEN whole THEN CAST(body AS JSON) ELSE CAST('{{}}' AS JSON) END AS j FROM (
    SELECT *, CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END AS whole FROM req_bodies))""")


def _ymd(f: str) -> str:
    return (f"COALESCE(list_bool_and(list_transform({f}, lambda x: "
            f"COALESCE(strftime(try_strptime(x, '%Y-%m-%d'), '%Y-%m-%d') = x, false))), true)")


def _errs(first: str = "") -> str:
    return f"""concat_ws(',', {first}
                 CASE WHEN bad_forecast_days OR forecast_days IS NULL OR forecast_days <> 7 THEN 'forecast_days' END,
                 CASE WHEN bad_forecast_open_days_only THEN 'forecast_open_days_only' END,
                 CASE WHEN bad_promo_dates OR NOT {_ymd('promo_dates')} THEN 'promo_dates' END,
                 CASE WHEN bad_school_holiday_dates OR NOT {_ymd('school_holiday_dates')} THEN 'school_holiday_dates' END,
                 CASE WHEN bad_current_stock OR current_stock < 0 THEN 'current_stock' END,
                 CASE WHEN bad_unit_price OR unit_price < 0 THEN 'unit_price' END,
                 CASE WHEN bad_reorder_lead_time_days OR reorder_lead_time_days < 1 OR reorder_lead_time_days > 30 THEN 'reorder_lead_time_days' END,
                 CASE WHEN bad_safety_stock_percentage OR safety_stock_percentage < 0 OR safety_stock_percentage > 1 THEN 'safety_stock_percentage' END)"""


_REQ_FIRST = "CASE WHEN NOT whole THEN 'body' END, CASE WHEN bad_name THEN 'name' END,"
cte("req_validated", ["req_variants"], f"SELECT *, {_errs(_REQ_FIRST)} AS errors FROM req_variants")


@register("validate_requests", sql("""
SELECT Store, request_id, name, current_stock, errors, errors = '' AS is_valid FROM req_validated""", "req_validated"))
def validate_requests(spark, sf):
    """Per-request rules -> failing field names; valid / rejected split."""
    v = vd.validate_requests(rq.request_variants(_state(spark, sf)))
    return v.select("Store", "request_id", "name", "current_stock", F.array_join("errors", ",").alias("errors"), "is_valid")


_SCEN_FIRST = "CASE WHEN bad_name OR name IS NULL OR length(name) > 100 THEN 'name' END,"


@register("validate_scenarios", sql(f"""
SELECT Store, comparison_id, position,
       concat_ws(',', CASE WHEN position IS NOT NULL AND own <> '' THEN own END,
                 CASE WHEN scenario_count < 1 OR scenario_count > 5 THEN 'scenarios' END) AS errors,
       (position IS NULL OR own = '') AND scenario_count BETWEEN 1 AND 5 AS is_valid, scenario_count
FROM (SELECT *, {_errs(_SCEN_FIRST)} AS own FROM (SELECT Store, comparison_id, position, scenario_count, {_TYPED} FROM (
  SELECT Store, comparison_id, scenario_count, CAST(p.p - 1 AS INTEGER) AS position,
         CASE WHEN json_type(l[p.p]) = 'OBJECT' THEN l[p.p] ELSE CAST('{{}}' AS JSON) END AS j
  FROM (SELECT *, CAST(COALESCE(len(l), 0) AS INTEGER) AS scenario_count FROM (
    SELECT Store, comparison_id, CASE WHEN json_valid(body) AND json_type(CASE WHEN json_valid(body) THEN body END, '$.scenarios') = 'ARRAY'
           THEN json_extract(CASE WHEN json_valid(body) THEN body END, '$.scenarios[*]') END AS l
    FROM (SELECT s.Store, c.comparison_id, replace(c.body, '{{d1}}', strftime(s.latest_date + 1, '%Y-%m-%d')) AS body
          FROM state s CROSS JOIN (VALUES {_text_rows(rq.COMPARISONS)}) c(comparison_id, body)))) x
  LEFT JOIN range(1, 20) p(p) ON p.p <= scenario_count)))""", "state"))
def validate_scenarios(spark, sf):
    """Scenario rules on the JSON text (types, name <= 100 chars, dates, ranges)
    and 1..5 scenarios per comparison, empty and broken comparisons included."""
    v = vd.validate_scenarios(rq.comparison_bodies(_state(spark, sf)))
    return v.select("Store", "comparison_id", "position", F.array_join("errors", ",").alias("errors"), "is_valid",
                    "scenario_count")


@register("request_defaults", sql("""
SELECT Store, request_id, COALESCE(forecast_days, 7) AS forecast_days,
       COALESCE(forecast_open_days_only, true) AS forecast_open_days_only,
       CAST(COALESCE(len(promo_dates), 0) AS INTEGER) AS n_promo_dates, COALESCE(reorder_lead_time_days, 3) AS reorder_lead_time_days,
       COALESCE(safety_stock_percentage, 0.15) AS safety_stock_percentage
FROM req_variants""", "req_variants"))
def request_defaults(spark, sf):
    """Absent request fields take the service defaults."""
    d = vd.request_defaults(rq.request_variants(_state(spark, sf)))
    return d.select("Store", "request_id", "forecast_days", "forecast_open_days_only",
                    F.size("promo_dates").alias("n_promo_dates"), "reorder_lead_time_days",
                    "safety_stock_percentage")


@register("parse_date_list", sql("""
SELECT Store, CAST(len(l) AS INTEGER) AS n_dates, array_to_string(l, '|') AS dates FROM (
  SELECT Store, list_filter(list_transform(string_split(txt, ','), lambda x: trim(x)), lambda x: x <> '') AS l FROM (
    SELECT Store, string_agg(strftime(date, '%Y-%m-%d'), ', ' ORDER BY step) || ',' AS txt
    FROM future_dates WHERE step <= 2 GROUP BY Store))""", "future_dates"))
def parse_date_list(spark, sf):
    """'a, b,' typed text -> trimmed, non-empty date list."""
    st = _state(spark, sf)
    dates = F.slice(fc.future_dates(F.col("latest_date"), F.lit(7), F.lit(True), F.col("closes_on_sundays")), 1, 2)
    txt = F.concat(F.array_join(F.transform(dates, lambda d: F.date_format(d, "yyyy-MM-dd")), ", "), F.lit(","))
    parsed = st.select("Store", cal.parse_date_list(txt).alias("l"))
    return parsed.select("Store", F.size("l").alias("n_dates"), F.array_join("l", "|").alias("dates"))


# ---- forecast history -----------------------------------------------------------------------

def _log_source(spark, sf):
    """Validated request variants -> defaults -> forecasts + insights -> log rows. The typed fields are
    checkpointed: without that, the optimiser repeats the parse of the text for every use of a field."""
    req = tables.reused(spark, vd.validate_requests(rq.request_variants(_state(spark, sf)))).filter("is_valid")
    f = dc.with_insights(fc.forecast_joined(vd.request_defaults(req)))
    f = f.withColumn("response_average", (F.col("total_predicted_sales") / F.size("days")).cast("bigint"))
    f = f.withColumn("created_at", F.col("latest_date").cast("timestamp_ntz") + F.make_interval(hours=F.col("variant")))
    return hs.log_rows(f)


def _log(spark, sf):
    """The log as a versioned table with one append, and its schema."""
    rows = _log_source(spark, sf)
    log = versions.VersionedLog(spark, scratch_path(spark, "forecast_log"))
    log.append(rows)
    return log, rows.schema


def _log_table(spark, sf):
    log, schema = _log(spark, sf)
    return log.read(schema)


cte("req_future", ["req_validated", "future_dates", "features"], _future_pred(
    "(SELECT f.*, r.request_id, r.promo_dates, r.school_holiday_dates FROM future_dates f "
    "JOIN req_validated r ON r.Store = f.Store AND r.errors = '')",
    "COALESCE(list_contains(fd.promo_dates, strftime(fd.date, '%Y-%m-%d')), false)",
    "COALESCE(list_contains(fd.school_holiday_dates, strftime(fd.date, '%Y-%m-%d')), false)"))

cte("log_src", ["req_validated", "req_future"], """
SELECT r.request_id AS id, CAST(r.Store AS INTEGER) AS store_id, r.variant,
       r.current_stock, t.total, t.n, COALESCE(r.reorder_lead_time_days, 3) AS lead, COALESCE(r.safety_stock_percentage, 0.15) AS safety,
       CAST(round_even(CAST(t.total AS DOUBLE) / t.n, 0) AS BIGINT) AS avg_ins,
       CAST(r.latest_date AS TIMESTAMP) + INTERVAL (r.variant) HOUR AS created_at
FROM req_validated r JOIN (SELECT request_id, CAST(SUM(predicted_sales) AS BIGINT) AS total, COUNT(*) AS n
                           FROM req_future GROUP BY 1) t ON r.request_id = t.request_id
WHERE r.errors = ''""")

cte("log", ["log_src"], """
SELECT id, store_id, total AS total_predicted_sales, avg_ins AS average_predicted_sales,
       CASE WHEN current_stock IS NULL THEN NULL WHEN current_stock - total < 0 THEN 'high'
            WHEN current_stock <= avg_ins * lead + CAST(total AS DOUBLE) * safety THEN 'medium' ELSE 'low' END AS stockout_risk,
       CASE WHEN current_stock IS NULL THEN NULL
            WHEN current_stock - total < 0 OR current_stock <= avg_ins * lead + CAST(total AS DOUBLE) * safety THEN true ELSE false END
         AS reorder_needed,
       created_at, n
FROM log_src""")

_LOG_COLS = "id, store_id, total_predicted_sales, average_predicted_sales, stockout_risk, reorder_needed, created_at"


def _summary(df):
    return df.select("id", "store_id", "total_predicted_sales", "average_predicted_sales", "stockout_risk",
                     "reorder_needed", "created_at")


@register("log_append", sql(f"SELECT {_LOG_COLS} FROM log", "log"))
def log_append(spark, sf):
    """One log row per valid request: payload JSON + 4 extracted columns,
    appended to the versioned table as its first version."""
    return _summary(_log_table(spark, sf))


@register("log_recent", sql(f"SELECT {_LOG_COLS} FROM log ORDER BY created_at DESC, id DESC LIMIT 20", "log"))
def log_recent(spark, sf):
    """The 20 newest entries (a report limit: the limit is the feature)."""
    log, schema = _log(spark, sf)
    return _summary(log.recent(schema, 20))


@register("log_get", sql(f"""
SELECT {_LOG_COLS}, 'open days only' AS forecast_mode, CAST(n AS INTEGER) AS n_forecast_days FROM log WHERE id = 300""",
                         "log"))
def log_get(spark, sf):
    """One full record by id, from the files whose id range holds it (payloads parsed back from JSON)."""
    log, schema = _log(spark, sf)
    rec = hs.parse_response(log.get(300, schema))
    return rec.select("id", "store_id", "total_predicted_sales", "average_predicted_sales", "stockout_risk",
                      "reorder_needed", "created_at", F.col("response.forecast_mode").alias("forecast_mode"),
                      F.size("response.forecast").alias("n_forecast_days"))


@register("log_delete", sql(f"SELECT {_LOG_COLS} FROM log WHERE id NOT IN (300, 301)", "log"))
def log_delete(spark, sf):
    """Delete ids 300 and 301: files that hold them are rewritten without them, as the next version."""
    log, schema = _log(spark, sf)
    return _summary(log.read(schema, log.delete([300, 301], schema)))


@register("log_explode", sql("""
SELECT l.id, l.store_id, strftime(f.date, '%Y-%m-%d') AS date, f.predicted_sales, f.day_of_week
FROM log l JOIN req_future f ON l.id = f.request_id""", "log", "req_future"))
def log_explode(spark, sf):
    """Stored forecasts re-opened as day rows."""
    return hs.log_explode(_log_table(spark, sf)).select("id", "store_id", "date", "predicted_sales", "day_of_week")


@register("json_extract_insights", sql(f"SELECT {_LOG_COLS.replace(', created_at', '')} FROM log", "log"))
def json_extract_insights(spark, sf):
    """The 4 summary fields pulled from the nested response JSON (NULL if absent)."""
    p = hs.parse_response(_log_table(spark, sf))
    bi = "response.business_insights"
    return p.select("id", "store_id", F.col(f"{bi}.total_predicted_sales").alias("total_predicted_sales"),
                    F.col(f"{bi}.average_predicted_sales").alias("average_predicted_sales"),
                    F.col(f"{bi}.stockout_risk").alias("stockout_risk"),
                    F.col(f"{bi}.reorder_needed").alias("reorder_needed"))


@register("json_cast", sql("""
SELECT l.id, CAST(COALESCE(len(r.promo_dates), 0) AS INTEGER) AS n_promo_dates,
       CAST(r.promo_dates[1] AS DATE) AS first_promo_date,
       CAST(l.reorder_needed AS INTEGER) AS reorder_needed_int
FROM log l JOIN log_src s ON l.id = s.id JOIN req_variants r ON r.request_id = l.id""", "log", "log_src", "req_variants"))
def json_cast(spark, sf):
    """JSON text -> typed array / date, boolean -> int."""
    p = hs.parse_response(_log_table(spark, sf))
    return p.select("id", F.size("request.promo_dates").alias("n_promo_dates"),
                    F.to_date(F.try_element_at("request.promo_dates", F.lit(1))).alias("first_promo_date"),
                    F.col("reorder_needed").cast("int").alias("reorder_needed_int"))


_REPORT = T.StructType([
    T.StructField("report_type", T.StringType()), T.StructField("generated_at", T.StringType()),
    T.StructField("insights", hs.INSIGHTS), T.StructField("forecast_data", T.ArrayType(hs.DAY))])


@register("report_json_export", sql("""
SELECT l.id, 'Executive Forecast Report' AS report_type, strftime(l.created_at, '%Y-%m-%dT%H:%M:%S.000Z') AS generated_at,
       l.total_predicted_sales, l.stockout_risk, CAST(l.n AS INTEGER) AS n_forecast_days, f.first_date
FROM log l JOIN (SELECT Store, strftime(min(date), '%Y-%m-%d') AS first_date FROM future_pred GROUP BY Store) f
  ON l.store_id = f.Store""", "log", "future_pred"))
def report_json_export(spark, sf):
    """Forecast report documents {report_type, generated_at, insights, forecast_data}: one pretty JSON file per
    report, published when the job commits, and read back from the files."""
    p = hs.parse_response(_log_table(spark, sf))
    doc = F.struct(F.lit("Executive Forecast Report").alias("report_type"),
                   F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("generated_at"),
                   F.col("response.business_insights").alias("insights"),
                   F.col("response.forecast").alias("forecast_data"))
    path = reports.write_reports(p.select(F.format_string("forecast-report-%d", "id").alias("name"), F.to_json(doc).alias("document")),
                                 scratch_path(spark, "forecast_reports"))
    back = spark.read.schema(_REPORT).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return back.select(F.regexp_extract(F.col("_metadata.file_name"), r"-(\d+)\.json$", 1).cast("bigint").alias("id"), "report_type", "generated_at",
                       F.col("insights.total_predicted_sales").alias("total_predicted_sales"),
                       F.col("insights.stockout_risk").alias("stockout_risk"),
                       F.size("forecast_data").alias("n_forecast_days"),
                       F.col("forecast_data")[0]["date"].alias("first_date"))


@register("report_csv_export", sql("""
SELECT Store || ',' || name || ',' || total || ',' ||
       CASE WHEN COALESCE(expected_revenue, 0) = 0 THEN '' ELSE CAST(expected_revenue AS VARCHAR) END || ',' ||
       COALESCE(risk, '') || ',' || CASE WHEN needed THEN 'Yes' ELSE 'No' END || ',' || COALESCE(qty, 0) AS line
FROM scen_ins""", "scen_ins"))
def report_csv_export(spark, sf):
    """Scenario report rows as CSV text: header, NULL -> empty, quoted only
    when containing ',' or '\"', quotes doubled; lines read back as text."""
    st = _state(spark, sf)
    s = dc.with_insights(fc.forecast_joined(rq.scenario_requests(st)))
    rev = F.when(F.coalesce(F.col("expected_revenue"), F.lit(0.0)) == 0, F.lit("")).otherwise(
        F.col("expected_revenue").cast("string"))
    rows = s.select(F.col("Store").cast("string").alias("Store"), F.col("name").alias("Scenario"),
                    F.col("total_predicted_sales").alias("Total Sales"), rev.alias("Revenue"),
                    F.col("stockout_risk").alias("Stockout Risk"),
                    F.when(F.col("reorder_needed"), "Yes").otherwise("No").alias("Reorder Needed"),
                    F.coalesce(F.col("recommended_reorder_quantity"), F.lit(0).cast("bigint")).alias("Recommended Qty"))
    path = files.write_csv(rows, scratch_path(spark, "scenario_report_csv"), quote='"', escape='"',
                           nullValue="", emptyValue="")
    header = ",".join(rows.columns)
    return spark.read.text(path).filter(F.col("value") != header).select(F.col("value").alias("line"))


_SCENARIO_REPORT = T.StructType([
    T.StructField("report_type", T.StringType()), T.StructField("generated_at", T.StringType()),
    T.StructField("best_scenario", T.StructType([T.StructField("scenario_name", T.StringType()), T.StructField("reason", T.StringType())])),
    T.StructField("scenarios", T.ArrayType(T.StructType([
        T.StructField("scenario_name", T.StringType()), T.StructField("business_insights", hs.INSIGHTS),
        T.StructField("forecast_data", T.ArrayType(hs.DAY))])))])


@register("report_scenario_json", sql("""
SELECT b.Store, 'Scenario Comparison Report' AS report_type, b.name AS best_scenario, CAST(5 AS INTEGER) AS n_scenarios,
       t.names AS scenario_names, t.total AS total_all_scenarios, CAST(35 AS INTEGER) AS n_days
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Store ORDER BY score DESC, position) AS r FROM scen_score) b
JOIN (SELECT Store, string_agg(name, '|' ORDER BY position) AS names, CAST(sum(total) AS BIGINT) AS total FROM scen_ins GROUP BY 1) t
  ON t.Store = b.Store WHERE b.r = 1""", "scen_score", "scen_ins"))
def report_scenario_json(spark, sf):
    """Scenario comparison reports {report_type, generated_at, best_scenario,
    scenarios} written as JSON files, one document per store, and read back."""
    s = dc.with_insights(fc.forecast_joined(rq.scenario_requests(_state(spark, sf))))
    scored = dc.score_scenarios(s)
    one = F.struct("position", F.col("name").alias("scenario_name"), dc.insights_struct().alias("business_insights"),
                   hs.day_records().alias("forecast_data"))
    per = scored.groupBy("Store").agg(F.array_sort(F.collect_list(one)).alias("scenarios"), F.max("latest_date").alias("latest"))
    best = dc.best_scenario(scored).select(F.col("Store").alias("_s"), F.struct(
        F.col("best_scenario").alias("scenario_name"), "reason").alias("best"))
    doc = per.join(best, F.col("Store") == F.col("_s")).select(
        "Store", F.lit("Scenario Comparison Report").alias("report_type"),
        F.date_format(F.col("latest").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("generated_at"),
        F.col("best").alias("best_scenario"), F.transform("scenarios", lambda x: x.dropFields("position")).alias("scenarios"))
    path = scratch_path(spark, "scenario_report_json")
    doc.write.json(path)
    back = spark.read.schema(T.StructType([T.StructField("Store", T.IntegerType()), *_SCENARIO_REPORT.fields])).json(path)
    total = F.aggregate("scenarios", F.lit(0).cast("bigint"), lambda a, x: a + x["business_insights"]["total_predicted_sales"])
    days = F.aggregate("scenarios", F.lit(0), lambda a, x: a + F.size(x["forecast_data"]))
    return back.select("Store", "report_type", F.col("best_scenario.scenario_name").alias("best_scenario"),
                       F.size("scenarios").alias("n_scenarios"), F.array_join("scenarios.scenario_name", "|").alias("scenario_names"),
                       total.alias("total_all_scenarios"), days.alias("n_days"))


_FALLBACK = f"""CASE WHEN position % 2 = 0 THEN {{rec}}
            WHEN COALESCE(needed, false) THEN '{dc.TEXT_REPORT_REORDER.split("{qty}")[0]}' || COALESCE(CAST(qty AS VARCHAR), '') || '{dc.TEXT_REPORT_REORDER.split("{qty}")[1]}'
            ELSE '{dc.TEXT_REPORT_SUFFICIENT}' END"""


@register("report_recommendation", sql("SELECT Store, position, " + _FALLBACK.format(rec=f"""CASE WHEN current_stock IS NULL THEN '{dc.TEXT_NO_STOCK}'
            WHEN risk = 'high' THEN '{dc.TEXT_HIGH}' WHEN risk = 'medium' THEN '{dc.TEXT_MEDIUM}' ELSE '{dc.TEXT_LOW}' END""")
                                       + " AS recommendation FROM scen_ins", "scen_ins"))
def report_recommendation(spark, sf):
    """The report's recommendation: the service text, or a text by the reorder flag
    where it is missing (here: taken away from every second scenario)."""
    s = dc.with_insights(fc.forecast_joined(rq.scenario_requests(_state(spark, sf))))
    text = F.when(F.col("position") % 2 == 0, F.col("recommendation"))
    return s.select("Store", "position", dc.report_recommendation(
        text, F.col("reorder_needed"), F.col("recommended_reorder_quantity")).alias("recommendation"))
