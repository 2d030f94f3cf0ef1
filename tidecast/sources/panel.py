"""Adapter from the TPC-H-like testdata to the demand panel.

A store is a supplier nation, a day is a ship date. The panel is built with
one aggregation over ``lineitem ⋈ supplier``; its grain is (Store, Date), so
every per-store series holds at most one row per calendar day no matter how
large ``lineitem`` grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import iso_day_of_week
from ..schemas import INPUTS
from .files import require_contract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; the columns we rely on are checked against their expected
    types from the file footer, so a changed table fails at once and by name."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return require_contract(df, name, INPUTS[name]) if name in INPUTS else df


def _closed_sunday(store: Column, dow: Column) -> Column:
    # Stores with Store % 4 = 3 trade every day; the others close on Sundays.
    return (dow == 7) & (store % 4 != 3)


def sales_daily(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Daily sales fact: Store, Date, DayOfWeek, Sales, Customers, Open, Promo,
    StateHoliday, SchoolHoliday (schema ``schemas.SALES_DAILY``).

    ``grain="nation"`` (the fixture: 25 stores) or ``"supplier"`` (one store
    per supplier: 10,000 x SF stores, for scale probes)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_discount",
        F.to_date("l_shipdate").alias("Date"))
    store = F.col("s_nationkey") if grain == "nation" else F.col("s_suppkey").cast("int")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", store.alias("Store"))
    # No join hint: the supplier side is broadcast by Spark while its scan is
    # below the broadcast threshold, sort-merge (with AQE skew splits) beyond.
    daily = (li.join(sup, li.l_suppkey == sup.s_suppkey)
             .groupBy("Store", "Date")
             .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
                  F.count_distinct("l_orderkey").alias("Customers"),
                  F.max(F.when(F.col("l_discount") >= 0.095, 1).otherwise(0)).alias("Promo")))
    dow = iso_day_of_week(F.col("Date"))
    closed = _closed_sunday(F.col("Store"), dow)
    holiday = (F.month("Date") == 12) & F.dayofmonth("Date").isin(25, 26)
    return daily.select(
        "Store", "Date",
        dow.alias("DayOfWeek"),
        F.when(closed, F.lit(0).cast("bigint")).otherwise(F.col("qty")).alias("Sales"),
        "Customers",
        F.when(closed, 0).otherwise(1).alias("Open"),
        F.col("Promo").cast("int").alias("Promo"),
        F.when(holiday, "c").otherwise("0").alias("StateHoliday"),
        F.month("Date").isin(7, 8).cast("int").alias("SchoolHoliday"),
    )


def store_dim(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Store dimension (schema ``schemas.STORE_DIM``), one row per store."""
    if grain == "nation":
        src, n = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    else:
        src, n = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("int")
    no_comp = (n % 5 == 0)
    no_promo2 = (n % 2 == 0)
    return src.select(
        n.alias("Store"),
        F.element_at(F.array(*[F.lit(c) for c in "abcd"]), (n % 4 + 1).cast("int")).alias("StoreType"),
        F.element_at(F.array(*[F.lit(c) for c in "abc"]), (n % 3 + 1).cast("int")).alias("Assortment"),
        F.when(~no_comp, 100 * (n.cast("double") + 1)).alias("CompetitionDistance"),
        F.when(~no_comp, n % 12 + 1).alias("CompetitionOpenSinceMonth"),
        F.when(~no_comp, n + 1990).alias("CompetitionOpenSinceYear"),
        (n % 2).alias("Promo2"),
        F.when(~no_promo2, n + 1).alias("Promo2SinceWeek"),
        F.when(~no_promo2, F.lit(1995)).alias("Promo2SinceYear"),
    )


def product_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-day series (schema ``schemas.PRODUCT_DAILY``): a product is a
    part type; 0-based day of week as in the synthetic series."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        F.to_date("l_shipdate").alias("date"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    g = (li.join(part, li.l_partkey == part.p_partkey)
         .groupBy(F.col("p_type").alias("product"), "date")
         .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units_sold"),
              F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("_cents"),
              F.sum(F.col("p_size").cast("bigint")).alias("stock"),
              F.max(F.when(F.col("l_discount") >= 0.095, 1).otherwise(0)).alias("promotion")))
    return g.select(
        "date", "product", "units_sold",
        # integer cents per unit (floor), so the price is exact and reproducible
        (F.expr("_cents div units_sold") / 100.0).alias("price"),
        "stock", F.col("promotion").cast("int").alias("promotion"),
        (iso_day_of_week(F.col("date")) - 1).alias("day_of_week"),
        F.month("date").alias("month"),
    )
