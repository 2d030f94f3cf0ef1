"""Request and scenario tables over the store panel.

A request/scenario list is a small parameter list; it is attached to every
store with a narrow ``inline`` of a literal array (one input row per store,
no join), so the work grows with the number of stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import forecast as fc
from ..operators import validate as vd

# Scenario fixture (fixed values): name, promo (first two future dates?),
# current_stock, unit_price, lead time, safety share.
SCENARIOS = [
    ("Normal", False, 300, 12.5, 3, 0.15),
    ("Promo", True, 300, 10.0, 3, 0.15),
    ("Lean", False, 50, 12.5, 7, 0.30),
    ("NoStock", False, None, None, 3, 0.15),
    ("Twin of Normal", False, 300, 12.5, 3, 0.15),
]


def _lit(v, t: str) -> Column:
    return F.lit(None).cast(t) if v is None else F.lit(v).cast(t)


#: Comparisons and positions that the id of a scenario request has room for.
MAX_COMPARISONS, MAX_POSITIONS = 100_000, 10


def _scenario_id() -> Column:
    return (F.col("Store").cast("bigint") * (MAX_COMPARISONS * MAX_POSITIONS) + F.col("comparison_id") * MAX_POSITIONS
            + F.col("position")).cast("bigint").alias("request_id")


def scenario_requests(state: DataFrame, scenarios=SCENARIOS, comparison_id: int = 0,
                      more: dict | None = None) -> DataFrame:
    """state x scenarios: one row per (Store, comparison, scenario) carrying
    the state; ``more`` adds further comparisons {comparison_id: scenarios}. For a few
    scenarios, which become part of the plan; many come as a table (``attach_scenarios``)."""
    comparisons = {comparison_id: scenarios, **(more or {})}
    if any(not 0 <= c < MAX_COMPARISONS or len(sc) > MAX_POSITIONS for c, sc in comparisons.items()):
        raise ValueError(f"request_id has room for {MAX_COMPARISONS} comparisons of {MAX_POSITIONS} scenarios")
    structs = [s for cid, sc in comparisons.items() for s in _scenario_structs(sc, cid)]
    return state.select("*", F.inline(F.array(*structs))).select("*", _scenario_id())


#: A scenario table: ``Store`` null means every store; ``promo``: the first two future days are promoted.
SCENARIO_TABLE = ("Store int, comparison_id int, position int, name string, promo boolean, current_stock bigint, unit_price double, "
                  "reorder_lead_time_days int, safety_stock_percentage double")
#: Scenario rows are broadcast up to so many bytes (fixed-width fields and names), else joined by shuffle.
BROADCAST_BYTES = 8 << 20
SALTS = 64


def scenario_table(spark, scenarios=SCENARIOS, comparison_id: int = 0, store: int | None = None) -> DataFrame:
    return spark.createDataFrame([(store, comparison_id, k, *s) for k, s in enumerate(scenarios)], SCENARIO_TABLE)


def attach_scenarios(state: DataFrame, table: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """state x the rows of a scenario table that name its store or none: as ``scenario_requests``, with a plan that does
    not grow with the scenarios. Up to ``broadcast_bytes`` (measured) the table is broadcast. Beyond, rows of
    a store are joined on it, and rows of every store meet the states by salt: a scenario has one of ``salts``
    salts, a state all of them, so the pairs spread over ``salts`` keys and neither side is gathered."""
    facts = table.agg(F.sum(F.length("name") + 64).alias("size"), F.max("comparison_id").alias("c"), F.max("position").alias("p"),
                      F.min("comparison_id").alias("c0"), F.min("position").alias("p0")).first()
    if facts.c is not None and not (0 <= facts.c0 and facts.c < MAX_COMPARISONS and 0 <= facts.p0 and facts.p < MAX_POSITIONS):
        raise ValueError(f"request_id has room for {MAX_COMPARISONS} comparisons of {MAX_POSITIONS} scenarios")
    rows = table.withColumnRenamed("Store", "_for")
    if (facts["size"] or 0) <= broadcast_bytes:
        out = state.join(F.broadcast(rows), F.col("_for").isNull() | (F.col("_for") == F.col("Store")))
    else:
        own = state.join(rows.filter("_for IS NOT NULL"), F.col("_for") == F.col("Store"))
        salt = F.pmod(F.xxhash64("comparison_id", "position"), F.lit(salts)).cast("int")
        every = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))) \
            .join(rows.filter("_for IS NULL").withColumn("_salt", salt), "_salt").drop("_salt")
        out = own.unionByName(every)
    horizon = fc.future_dates(F.col("latest_date"), F.lit(7), F.lit(True), F.col("closes_on_sundays"))
    none = F.array().cast("array<date>")
    return out.select(
        *state.columns, "comparison_id", "position", "name", F.lit(7).alias("forecast_days"), F.lit(True).alias("forecast_open_days_only"),
        F.when(F.col("promo"), F.slice(horizon, 1, 2)).otherwise(none).alias("promo_dates"), none.alias("school_holiday_dates"),
        "current_stock", "unit_price", "reorder_lead_time_days", "safety_stock_percentage", _scenario_id())


def _scenario_structs(scenarios, comparison_id: int) -> list[Column]:
    horizon_dates = fc.future_dates(F.col("latest_date"), F.lit(7), F.lit(True), F.col("closes_on_sundays"))
    structs = []
    for pos, (name, promo, stock, price, lead, safety) in enumerate(scenarios):
        promo_dates = F.slice(horizon_dates, 1, 2) if promo else F.array().cast("array<date>")
        structs.append(F.struct(
            F.lit(comparison_id).alias("comparison_id"), F.lit(pos).alias("position"), F.lit(name).alias("name"),
            F.lit(7).alias("forecast_days"), F.lit(True).alias("forecast_open_days_only"),
            promo_dates.alias("promo_dates"), F.array().cast("array<date>").alias("school_holiday_dates"),
            _lit(stock, "bigint").alias("current_stock"), _lit(price, "double").alias("unit_price"),
            F.lit(lead).alias("reorder_lead_time_days"), F.lit(safety).cast("double").alias("safety_stock_percentage")))
    return structs


# Raw request texts for validation (fixed values), numbered from 0; {d1} = the day
# after the store's latest date.
REQUEST_VARIANTS = [
    '{"name": "default", "forecast_days": 7}',
    '{"name": "with stock", "forecast_days": 7, "promo_dates": ["{d1}"], "current_stock": 18000, "unit_price": 12.5, '
    '"reorder_lead_time_days": 3, "safety_stock_percentage": 0.15}',
    '{"name": "fourteen days", "forecast_days": 14}',
    '{"name": "no horizon"}',
    '{"name": "slash date", "forecast_days": 7, "promo_dates": ["2015/08/01"]}',
    '{"name": "negative stock", "forecast_days": 7, "current_stock": -1}',
    '{"name": "lead zero", "forecast_days": 7, "reorder_lead_time_days": 0}',
    '{"name": "lead 31", "forecast_days": 7, "reorder_lead_time_days": 31}',
    '{"name": "safety 1.5", "forecast_days": 7, "safety_stock_percentage": 1.5}',
    '{"name": "' + "x" * 101 + '", "forecast_days": 7}',
    '{"name": "stock text", "forecast_days": 7, "current_stock": "abc"}',
    '{"name": "stock half", "forecast_days": 7, "current_stock": 7.5}',
    '{"name": "promo text", "forecast_days": 7, "promo_dates": "2015-08-01"}',
    '{"name": "safety text", "forecast_days": 7, "safety_stock_percentage": "lots"}',
    '{"name": "open text", "forecast_days": 7, "forecast_open_days_only": "maybe"}',
    '{"name": "holiday slash", "forecast_days": 7, "school_holiday_dates": ["2015/08/01", "{d1}"]}',
    '{"name": "promo null", "forecast_days": 7, "promo_dates": null}',
    '{"name": "numbers as text", "forecast_days": "7", "current_stock": "120", "unit_price": "9.5"}',
    '{"name": "null stock", "forecast_days": 7, "current_stock": null, "school_holiday_dates": ["{d1}"]}',
    '{"name": "open one", "forecast_days": 7.0, "forecast_open_days_only": 1}',
    '{"name": "price list", "forecast_days": 7, "unit_price": [1]}',
    '{"name": "exact stock", "forecast_days": 7, "current_stock": 9007199254740993}',
    '{"name": "stock beyond 64 bits", "forecast_days": 7, "current_stock": 1e300}',
    '{"forecast_days": 7, "broken',
    '[7]',
]


def request_bodies(state: DataFrame, variants=REQUEST_VARIANTS) -> DataFrame:
    """Raw request texts per store, keyed request_id = Store * 100 + variant (the
    state columns ride along: no join back to the state later)."""
    if len(variants) > 100:
        raise ValueError("request_id has room for 100 variants of a store")
    day = F.date_format(F.date_add("latest_date", 1), "yyyy-MM-dd")
    structs = [F.struct(F.lit(v).alias("variant"), F.replace(F.lit(body), F.lit("{d1}"), day).alias("body"))
               for v, body in enumerate(variants)]
    out = state.select("*", F.inline(F.array(*structs)))
    return out.withColumn("request_id", F.col("Store").cast("bigint") * 100 + F.col("variant"))


def request_variants(state: DataFrame, variants=REQUEST_VARIANTS) -> DataFrame:
    """The request texts parsed: typed columns and ``type_errors`` beside the text."""
    return vd.parse_requests(request_bodies(state, variants))


_OK = '{"name": "A", "forecast_days": 7}'
# Scenario comparison texts (fixed values), numbered from 0.
COMPARISONS = [
    '{"scenarios": [' + ", ".join([_OK] * 5) + "]}",
    '{"scenarios": [' + ", ".join([_OK] * 6) + "]}",
    '{"scenarios": [{"name": "' + "x" * 101 + '", "forecast_days": 7}]}',
    '{"scenarios": []}',
    '{"scenarios": [{"name": "B", "forecast_days": "x", "current_stock": "abc", "school_holiday_dates": ["2015/08/01"]}, ' + _OK + "]}",
    '{"other": 1}',
    '{"scenarios": [{"name": 5, "forecast_days": 7, "promo_dates": ["{d1}"]}, 7]}',
    "broken {",
]


def comparison_bodies(state: DataFrame) -> DataFrame:
    """Raw scenario comparisons per store."""
    day = F.date_format(F.date_add("latest_date", 1), "yyyy-MM-dd")
    structs = [F.struct(F.lit(i).alias("comparison_id"), F.replace(F.lit(body), F.lit("{d1}"), day).alias("body"))
               for i, body in enumerate(COMPARISONS)]
    return state.select("Store", F.inline(F.array(*structs)))


def default_requests(state: DataFrame, open_days_only: bool = True) -> DataFrame:
    """One service-default request per store (request_id = Store)."""
    return state.select(
        "*", F.col("Store").cast("bigint").alias("request_id"), F.lit(7).alias("forecast_days"),
        F.lit(open_days_only).alias("forecast_open_days_only"),
        F.array().cast("array<date>").alias("promo_dates"), F.array().cast("array<date>").alias("school_holiday_dates"),
        F.lit(None).cast("bigint").alias("current_stock"), F.lit(None).cast("double").alias("unit_price"),
        F.lit(3).alias("reorder_lead_time_days"), F.lit(0.15).alias("safety_stock_percentage"))


# Promo / school-holiday plans as horizon steps (fixed values): plan id,
# promo steps, school-holiday steps.
PLANS = [
    (0, [], []),
    (1, [1, 2], [6, 7]),
    (2, [3], [1]),
    (3, [2, 5], []),
    (4, [7], [3, 4]),
    (5, [1, 4, 7], [2]),
]


def plan_requests(state: DataFrame, plans=PLANS) -> DataFrame:
    """Requests whose planned dates are given as horizon steps of each store."""
    dates = fc.future_dates(F.col("latest_date"), F.lit(7), F.lit(True), F.col("closes_on_sundays"))

    def at(steps):
        return F.array(*[F.element_at(dates, s) for s in steps]) if steps else F.array().cast("array<date>")
    structs = [F.struct(F.lit(pid).alias("plan"), at(p).alias("promo_dates"), at(h).alias("school_holiday_dates"))
               for pid, p, h in plans]
    out = state.select("*", F.inline(F.array(*structs)))
    return out.select(
        "*", (F.col("Store").cast("bigint") * 10 + F.col("plan")).alias("request_id"), F.lit(7).alias("forecast_days"),
        F.lit(True).alias("forecast_open_days_only"), F.lit(None).cast("bigint").alias("current_stock"),
        F.lit(None).cast("double").alias("unit_price"), F.lit(3).alias("reorder_lead_time_days"),
        F.lit(0.15).alias("safety_stock_percentage"))
