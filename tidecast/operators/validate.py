"""Request validation: one error expression per rule, collected into an
``errors`` array; valid and rejected rows split on its emptiness.

Requests arrive as JSON text. ``parse_requests`` reads every field as a variant,
checks its JSON type (integer, numeric, boolean, array, text) and only then takes
the typed value, so a mistyped field is an error and never an absent one; the
text itself stays in the row. Absent fields take defaults, an explicit null is
allowed for ``current_stock`` and ``unit_price`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Request

#: JSON field -> (rule, type of the value). Order of the rules = order of the errors.
FIELDS = {
    "name": ("text", "string"),
    "forecast_days": ("integer", "int"),
    "forecast_open_days_only": ("boolean", "boolean"),
    "promo_dates": ("dates", "array<string>"),
    "school_holiday_dates": ("dates", "array<string>"),
    "current_stock": ("integer", "bigint"),
    "unit_price": ("numeric", "double"),
    "reorder_lead_time_days": ("integer", "int"),
    "safety_stock_percentage": ("numeric", "double"),
}
NULLABLE = ("current_stock", "unit_price")
_INT, _WHOLE = r"^[+-]?[0-9]{1,19}$", r"^([+-]?[0-9]{1,19})(\.0*)?$"
_NUM = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _typed(field: Column, rule: str, kind: str) -> tuple[Column, Column]:
    """(value, type is wrong) of a variant field."""
    t = F.schema_of_variant(field)
    text = F.try_variant_get(field, "$", "string")
    if rule == "text":
        return F.when(t == "STRING", text), t != "STRING"
    if rule == "dates":
        return F.try_variant_get(field, "$", "array<string>"), ~t.startswith("ARRAY")
    if rule == "boolean":
        true, false = [(t == "BOOLEAN") & (text == w) | t.isin("BIGINT", "STRING") & (text == n)
                       for w, n in (("true", "1"), ("false", "0"))]
        return F.when(true, True).when(false, False), ~(true | false)
    number = t.isin("BIGINT", "DOUBLE", "STRING") | t.startswith("DECIMAL")
    ok = number & text.rlike(_INT if rule == "integer" else _NUM)
    whole = F.try_variant_get(field, "$", "double")
    exact = whole
    if rule == "integer":  # 7.0 is an integer, 7.5 is not; the digits themselves are read, exact to 64 bits
        ok = ok | (number & (t != "STRING") & (whole == F.floor(whole)))
        digits = F.regexp_extract(text, _WHOLE, 1)
        exact = F.when(digits != "", digits.try_cast("bigint")).otherwise(whole.try_cast("bigint"))
    value = F.when(ok, exact)
    return value.try_cast(kind), ~ok | value.try_cast(kind).isNull()


def parse_requests(raw: DataFrame, body: str = "body") -> DataFrame:
    """Typed request columns and ``type_errors`` (names of mistyped fields, ``body``
    for a text that is no JSON object) of the JSON texts in ``body``."""
    v = F.try_parse_json(body)
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    obj = raw.withColumn("_v", F.when(whole, v)).withColumn("_whole", whole)
    return typed_fields(obj, "_v", F.when(~F.col("_whole"), F.lit("body"))).drop("_v", "_whole")


def typed_fields(df: DataFrame, variant: str, first_error: Column | None = None) -> DataFrame:
    """The request fields of a variant column, typed, and ``type_errors``."""
    values, wrong = [], [first_error] if first_error is not None else []
    for name, (rule, kind) in FIELDS.items():
        field = F.try_variant_get(variant, f"$.{name}", "variant")
        value, bad = _typed(field, rule, kind)
        null = F.is_variant_null(field)
        bad = F.when(field.isNull(), False).when(null, F.lit(name not in NULLABLE)).otherwise(bad)
        values.append(F.when(field.isNotNull() & ~null, value).alias(name))
        wrong.append(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)))
    errors = F.filter(F.array(*wrong), lambda x: x.isNotNull())
    return df.select("*", *values, errors.alias("type_errors"))


def is_ymd(s: Column) -> Column:
    """Strict Y-m-d: parses AND formats back to the same text."""
    d = F.try_to_date(s, "yyyy-MM-dd")
    return F.coalesce(F.date_format(d, "yyyy-MM-dd") == s, F.lit(False))


def _all_ymd(arr: Column) -> Column:
    return F.coalesce(F.forall(arr, lambda x: is_ymd(x)), F.lit(True))


def request_errors(scenario: bool = False, typed: bool = False) -> Column:
    """Names of the failing fields, in rule order; ``typed``: the rows come from
    ``parse_requests`` and carry ``type_errors``."""
    rules = [("body", F.array_contains("type_errors", "body"))] if typed else []
    wrong = (lambda f: F.array_contains("type_errors", f)) if typed else (lambda f: F.lit(False))
    if scenario:
        rules.append(("name", F.col("name").isNull() | (F.length("name") > 100)))
    elif typed:
        rules.append(("name", F.lit(False)))
    rules += [
        ("forecast_days", F.col("forecast_days").isNull() | (F.col("forecast_days") != 7)),
        *([("forecast_open_days_only", F.lit(False))] if typed else []),
        ("promo_dates", ~_all_ymd(F.col("promo_dates"))),
        ("school_holiday_dates", ~_all_ymd(F.col("school_holiday_dates"))),
        ("current_stock", F.col("current_stock") < 0),
        ("unit_price", F.col("unit_price") < 0),
        ("reorder_lead_time_days", (F.col("reorder_lead_time_days") < 1) | (F.col("reorder_lead_time_days") > 30)),
        ("safety_stock_percentage", (F.col("safety_stock_percentage") < 0) | (F.col("safety_stock_percentage") > 1)),
    ]
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)) | wrong(name), F.lit(name)) for name, cond in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def validate_requests(df: DataFrame, scenario: bool = False) -> DataFrame:
    return df.withColumn("errors", request_errors(scenario, typed="type_errors" in df.columns)) \
             .withColumn("is_valid", F.size("errors") == 0)


def validate_scenarios(comparisons: DataFrame, body: str = "body", most: int = 5) -> DataFrame:
    """One row per scenario of each comparison (JSON text with a ``scenarios`` list):
    the scenario's own rules plus 1..``most`` scenarios per comparison. A comparison
    without a scenario keeps one row (null position) that says so."""
    v = F.try_parse_json(body)
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    listed = F.try_variant_get(F.when(whole, v), "$.scenarios", "array<variant>")
    rows = comparisons.select("*", F.coalesce(F.size(listed), F.lit(0)).alias("scenario_count"),
                              F.posexplode_outer(listed).alias("position", "_v"))
    rows = rows.withColumn("_v", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v")))
    v = validate_requests(typed_fields(rows, "_v"), scenario=True).drop("_v", "type_errors")
    count = F.when((F.col("scenario_count") < 1) | (F.col("scenario_count") > most), F.array(F.lit("scenarios"))) \
        .otherwise(F.array().cast("array<string>"))
    own = F.when(F.col("position").isNull(), F.array().cast("array<string>")).otherwise(F.col("errors"))
    v = v.withColumn("errors", F.concat(own, count))
    return v.withColumn("is_valid", F.size("errors") == 0)


def request_defaults(df: DataFrame, d: Request = Request()) -> DataFrame:
    """Fill absent request fields with the service defaults and parse dates."""
    return df.select(
        *[c for c in df.columns if c not in (
            "forecast_days", "forecast_open_days_only", "promo_dates", "school_holiday_dates",
            "reorder_lead_time_days", "safety_stock_percentage")],
        F.coalesce("forecast_days", F.lit(d.forecast_days)).alias("forecast_days"),
        F.coalesce("forecast_open_days_only", F.lit(d.forecast_open_days_only)).alias("forecast_open_days_only"),
        F.transform(F.coalesce("promo_dates", F.array().cast("array<string>")),
                    lambda x: F.try_to_date(x, "yyyy-MM-dd")).alias("promo_dates"),
        F.transform(F.coalesce("school_holiday_dates", F.array().cast("array<string>")),
                    lambda x: F.try_to_date(x, "yyyy-MM-dd")).alias("school_holiday_dates"),
        F.coalesce("reorder_lead_time_days", F.lit(d.reorder_lead_time_days)).alias("reorder_lead_time_days"),
        F.coalesce("safety_stock_percentage", F.lit(d.safety_stock_percentage)).alias("safety_stock_percentage"),
    )
