"""Queries: scans/sinks, cleaning and profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import calendar as cal
from ..operators import clean, joins
from ..params import KEEP_COLUMNS
from ..session import scratch_path
from ..sources import files, panel, untrusted
from . import tables
from .oracle import cte, sql
from .registry import r4, register

SALES_COLS = [f.name for f in schemas.SALES_DAILY.fields]
STORE_COLS = [f.name for f in schemas.STORE_DIM.fields]


@register("src_sales_csv", sql("SELECT * FROM sales_daily", "sales_daily"))
def src_sales_csv(spark, sf):
    """Daily fact written as CSV and read back with the explicit schema."""
    df = panel.sales_daily(spark, sf)
    return files.csv_round_trip(spark, df, "sales_daily_csv", dateFormat="yyyy-MM-dd")


@register("src_store_csv", sql("SELECT * FROM store_dim", "store_dim"))
def src_store_csv(spark, sf):
    """Store dimension written as CSV and read back (NULLs survive as empty)."""
    return files.csv_round_trip(spark, panel.store_dim(spark, sf), "store_dim_csv")


@register("src_product_csv", sql("""
SELECT date, product, units_sold, ROUND(price, 4) AS price, stock, promotion, day_of_week, month
FROM product_daily""", "product_daily"))
def src_product_csv(spark, sf):
    """Product-day series (part type x ship date) through CSV."""
    df = files.csv_round_trip(spark, panel.product_daily(spark, sf), "product_daily_csv")
    return df.withColumn("price", r4("price"))


# First rows of every input, as text: table, its order, the columns shown.
_PREVIEW = {"sales_daily": (["Store", "Date"], ["Store", "Date", "Sales", "Open", "Promo"]),
            "store_dim": (["Store"], ["Store", "StoreType", "Assortment"]),
            "product_daily": (["product", "date"], ["product", "date", "units_sold", "stock"])}


@register("src_preview", sql(" UNION ALL ".join(f"""
SELECT '{t}' AS table_name, CAST(row_number() OVER (ORDER BY {", ".join(order)}) AS INTEGER) AS position,
       concat_ws(',', {", ".join(f"CAST({c} AS VARCHAR)" for c in shown)}) AS line FROM {t}
QUALIFY position <= 5""" for t, (order, shown) in _PREVIEW.items()), *_PREVIEW))
def src_preview(spark, sf):
    """The first five rows of each input table (the limit is the feature: a look before use)."""
    tables_ = {"sales_daily": panel.sales_daily(spark, sf), "store_dim": panel.store_dim(spark, sf), "product_daily": panel.product_daily(spark, sf)}
    out = None
    for t, (order, shown) in _PREVIEW.items():
        head = tables_[t].orderBy(*order).limit(5)
        rows = head.select(F.lit(t).alias("table_name"), F.row_number().over(Window.orderBy(*order)).alias("position"),
                           F.concat_ws(",", *[F.col(c).cast("string") for c in shown]).alias("line"))
        out = rows if out is None else out.unionByName(rows)
    return out


# Lines of the daily fact with faults by rule (fixed values): k = (7 Store + day of the year) % 40.
_COLUMNS = ["Store", "Date", "Sales", "Open", "Promo"]
_UNTRUSTED = T.StructType([T.StructField("Store", T.IntegerType(), False), T.StructField("Date", T.DateType(), False),
                           T.StructField("Sales", T.LongType()), T.StructField("Open", T.IntegerType()), T.StructField("Promo", T.IntegerType())])
_LINES_SQL = """
SELECT *, CASE WHEN k = 5 THEN 'S' || Store ELSE CAST(Store AS VARCHAR) END AS t0,
       CASE WHEN k = 1 THEN '2015/13/45' ELSE strftime(Date, '%Y-%m-%d') END AS t1,
       CASE WHEN k = 0 THEN 'n/a' WHEN k = 4 THEN '' ELSE CAST(Sales AS VARCHAR) END AS t2, CAST(Open AS VARCHAR) AS t3,
       CASE WHEN k = 5 THEN '7.5' ELSE CAST(Promo AS VARCHAR) END AS t4
FROM (SELECT *, (Store * 7 + dayofyear(Date)) % 40 AS k FROM sales_daily)"""


def _untrusted_file(spark, sf) -> str:
    """The daily fact as text files with a header, with faults by rule."""
    d = panel.sales_daily(spark, sf).withColumn("k", (F.col("Store") * 7 + F.dayofyear("Date")) % 40)
    text = {c: F.col(c).cast("string") for c in _COLUMNS}
    text["Store"] = F.when(F.col("k") == 5, F.concat(F.lit("S"), text["Store"])).otherwise(text["Store"])
    text["Date"] = F.when(F.col("k") == 1, "2015/13/45").otherwise(text["Date"])
    text["Sales"] = F.when(F.col("k") == 0, "n/a").when(F.col("k") == 4, "").otherwise(text["Sales"])
    text["Promo"] = F.when(F.col("k") == 5, "7.5").otherwise(text["Promo"])
    cells = [text[c] for c in _COLUMNS]
    line = F.when(F.col("k") == 2, F.concat_ws(",", *cells[:3])).when(F.col("k") == 3, F.concat_ws(",", *cells, F.lit("x"))) \
        .otherwise(F.concat_ws(",", *cells))
    path = scratch_path(spark, "untrusted_csv")
    header = spark.createDataFrame([(",".join(_COLUMNS),)], "line string")
    header.unionByName(d.select(line.alias("line"))).write.text(path)
    return path


@register("src_untrusted_csv", sql(f"""
SELECT CASE k WHEN 2 THEN concat_ws(',', t0, t1, t2) WHEN 3 THEN concat_ws(',', t0, t1, t2, t3, t4, 'x') ELSE concat_ws(',', t0, t1, t2, t3, t4) END AS line,
       CASE k WHEN 0 THEN 'Sales' WHEN 1 THEN 'Date' WHEN 2 THEN 'columns' WHEN 3 THEN 'columns' WHEN 5 THEN 'Store,Promo' ELSE '' END AS errors,
       CASE WHEN k IN (0, 1, 2, 3, 5) THEN NULL ELSE Store END AS Store, CASE WHEN k IN (0, 1, 2, 3, 5) THEN NULL ELSE Date END AS Date,
       CASE WHEN k IN (0, 1, 2, 3, 4, 5) THEN NULL ELSE CAST(Sales AS BIGINT) END AS Sales,
       CASE WHEN k IN (0, 1, 2, 3, 5) THEN NULL ELSE CAST(Open AS INTEGER) END AS Open,
       CASE WHEN k IN (0, 1, 2, 3, 5) THEN NULL ELSE CAST(Promo AS INTEGER) END AS Promo
FROM ({_LINES_SQL})""", "sales_daily"))
def src_untrusted_csv(spark, sf):
    """The daily fact from a file with broken lines: typed rows, and rejected lines with what is wrong."""
    df = untrusted.read_untrusted(spark, _untrusted_file(spark, sf), _UNTRUSTED)
    return df.withColumn("errors", F.array_join("errors", ","))


cte("untrusted_cells", ["sales_daily"], f"SELECT * FROM ({_LINES_SQL}) WHERE k NOT IN (2, 3)")


@register("src_inferred_types", sql("""
SELECT column_name, inferred_type, cells, CAST(empty AS BIGINT) AS empty FROM (
  SELECT 'Store' AS column_name, CASE WHEN bool_or(k = 5) THEN 'string' ELSE 'bigint' END AS inferred_type, count(*) AS cells, 0 AS empty FROM untrusted_cells
  UNION ALL SELECT 'Date', CASE WHEN bool_or(k = 1) THEN 'string' ELSE 'date' END, count(*), 0 FROM untrusted_cells
  UNION ALL SELECT 'Sales', CASE WHEN bool_or(k = 0) THEN 'string' ELSE 'bigint' END, count(*), count(*) FILTER (k = 4) FROM untrusted_cells
  UNION ALL SELECT 'Open', 'bigint', count(*), 0 FROM untrusted_cells
  UNION ALL SELECT 'Promo', CASE WHEN bool_or(k = 5) THEN 'double' ELSE 'bigint' END, count(*), 0 FROM untrusted_cells)""", "untrusted_cells"))
def src_inferred_types(spark, sf):
    """The type of every column of that file, judged by all its cells."""
    return untrusted.inferred_types(untrusted.read_lines(spark, _untrusted_file(spark, sf), _COLUMNS), _COLUMNS)


# What the panel needs of its input tables: column, Spark type, DuckDB type.
_CONTRACT = {
    "lineitem": [("l_orderkey", "bigint", "BIGINT"), ("l_suppkey", "bigint", "BIGINT"), ("l_quantity", "double", "DOUBLE"),
                 ("l_discount", "double", "DOUBLE"), ("l_shipdate", "timestamp_ntz", "TIMESTAMP")],
    "supplier": [("s_suppkey", "bigint", "BIGINT"), ("s_nationkey", "int", "INTEGER"), ("s_rating", "double", "DOUBLE")],
    "nation": [("n_nationkey", "int", "INTEGER")],
}


def _contract_sql() -> str:
    out = []
    for t, cols in _CONTRACT.items():
        for c, kind, duck in cols:
            there = f"(SELECT count(*) FROM (DESCRIBE {t}) WHERE column_name = '{c}')"
            typed = f"(SELECT count(*) FROM (DESCRIBE {t}) WHERE column_name = '{c}' AND column_type = '{duck}')"
            n = "0" if c == "s_rating" else f"COUNT({c})"
            out.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS expected_type, {there} > 0 AS present, "
                       f"{typed} > 0 AS type_ok, CAST({n} AS BIGINT) AS non_null, COUNT(*) AS rows FROM {t}")
    return " UNION ALL ".join(out)


@register("src_contract_check", sql(_contract_sql()))
def src_contract_check(spark, sf):
    """Required columns and types of the input tables as they are on disk, with
    non-null counts; one wanted column (s_rating) is not there and is reported."""
    out = None
    for name, cols in _CONTRACT.items():
        want = T.StructType([T.StructField(c, T._parse_datatype_string(kind)) for c, kind, _ in cols])
        rows = files.contract_check(spark.read.parquet(f"{sf}/{name}.parquet"), name, want).drop("actual_type")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("join_sales_store", sql("SELECT * FROM merged", "merged"))
def join_sales_store(spark, sf):
    """Daily fact LEFT JOIN store dimension on Store."""
    return tables.merged(spark, sf)


@register("parse_date", sql("""
SELECT Store, strftime(Date, '%Y-%m-%d') AS date_text, CAST(strptime(strftime(Date, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS Date
FROM sales_daily""", "sales_daily"))
def parse_date(spark, sf):
    """Dates as yyyy-MM-dd text parsed back to DATE."""
    txt = panel.sales_daily(spark, sf).select("Store", F.date_format("Date", "yyyy-MM-dd").alias("date_text"))
    return txt.select("Store", "date_text", cal.parse_date(F.col("date_text")).alias("Date"))


@register("filter_store", sql("SELECT * FROM sales_daily WHERE Store IN (1, 3, 7)", "sales_daily"))
def filter_store(spark, sf):
    """Keep a chosen set of stores (pushed below the aggregation by Catalyst)."""
    return clean.filter_store(panel.sales_daily(spark, sf), [1, 3, 7])


@register("filter_open_days", sql("""
SELECT Store, COUNT(*) AS rows_before, CAST(SUM(CASE WHEN Open <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS rows_removed,
       CAST(SUM(CASE WHEN Open = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rows_after
FROM sales_daily GROUP BY Store""", "sales_daily"))
def filter_open_days(spark, sf):
    """Open-day filter report per store: rows before / removed / after."""
    return clean.open_day_report(panel.sales_daily(spark, sf))


@register("drop_leakage_columns", sql("SELECT * EXCLUDE (Customers) FROM merged WHERE Open = 1", "merged"))
def drop_leakage_columns(spark, sf):
    """Open days without the Customers column (known only after the fact)."""
    return clean.drop_leakage_columns(clean.filter_open_days(tables.merged(spark, sf)))


@register("select_present", sql(f"SELECT {', '.join(KEEP_COLUMNS)} FROM merged WHERE Open = 1", "merged"))
def select_present(spark, sf):
    """Projection of the wanted columns that exist."""
    df = clean.drop_leakage_columns(clean.filter_open_days(tables.merged(spark, sf)))
    return clean.select_present(df)


def _cleaned(spark, sf):
    dim = panel.store_dim(spark, sf)
    df = joins.join_sales_store(panel.sales_daily(spark, sf), dim)
    df = clean.select_present(clean.drop_leakage_columns(clean.filter_open_days(df)))
    return df, dim


@register("impute_median", sql("""
SELECT Store, Date, CompetitionDistance FROM processed""", "processed"))
def impute_median(spark, sf):
    """CompetitionDistance filled with the exact median over the store dimension."""
    df, dim = _cleaned(spark, sf)
    return clean.impute_median(df, dim).select("Store", "Date", "CompetitionDistance")


@register("impute_zero", sql("""
SELECT Store, Date, CompetitionOpenSinceMonth, CompetitionOpenSinceYear, Promo2SinceWeek, Promo2SinceYear
FROM processed""", "processed"))
def impute_zero(spark, sf):
    """The four nullable 'since' columns filled with 0."""
    df, _ = _cleaned(spark, sf)
    return clean.impute_zero(df).select("Store", "Date", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear",
                                        "Promo2SinceWeek", "Promo2SinceYear")


_ONEHOT = ["StateHoliday_0", "StateHoliday_a", "StateHoliday_b", "StateHoliday_c", "StoreType_a", "StoreType_b",
           "StoreType_c", "StoreType_d", "Assortment_a", "Assortment_b", "Assortment_c"]


@register("one_hot", sql(f"SELECT Store, Date, {', '.join(_ONEHOT)} FROM processed", "processed"))
def one_hot(spark, sf):
    """Indicator columns over explicit category lists."""
    df, _ = _cleaned(spark, sf)
    return clean.one_hot(df).select("Store", "Date", *_ONEHOT)


@register("calendar_parts", sql("SELECT Store, Date, Month, Year, Day, IsWeekend FROM processed", "processed"))
def calendar_parts(spark, sf):
    """Month, Year, Day and IsWeekend of each open day."""
    return tables.processed(spark, sf).select("Store", "Date", "Month", "Year", "Day", "IsWeekend")


@register("sink_processed", sql("SELECT * FROM processed", "processed"))
def sink_processed(spark, sf):
    """The processed table written and read back."""
    return files.materialize(spark, tables.processed(spark, sf), "processed")


@register("head_preview", sql("SELECT * FROM processed ORDER BY Date, Store LIMIT 5", "processed"))
def head_preview(spark, sf):
    """First 5 rows of the processed table in (Date, Store) order."""
    return tables.processed(spark, sf).orderBy("Date", "Store").limit(5)


@register("sort_chronological", sql("""
SELECT Store, Date, CAST(ROW_NUMBER() OVER (PARTITION BY Store ORDER BY Date) AS INTEGER) AS position
FROM processed""", "processed"))
def sort_chronological(spark, sf):
    """Chronological position of every open day within its store (a sort per
    store partition, never a global sort)."""
    from pyspark.sql import Window
    w = Window.partitionBy("Store").orderBy("Date")
    return tables.processed(spark, sf).select("Store", "Date", F.row_number().over(w).alias("position"))


# ---- profiles ---------------------------------------------------------------------------------

@register("profile_overview", sql("""
SELECT COUNT(*) AS n_rows, MIN(Date) AS date_min, MAX(Date) AS date_max, COUNT(DISTINCT Store) AS n_stores
FROM merged""", "merged"))
def profile_overview(spark, sf):
    """Shape, date range and distinct stores of the merged table."""
    return tables.merged(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.min("Date").alias("date_min"),
                                          F.max("Date").alias("date_max"),
                                          F.count_distinct("Store").alias("n_stores"))


_MERGED_COLS = SALES_COLS + STORE_COLS[1:]


def _nulls_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, COUNT(*) AS n FROM merged"
             for c in _MERGED_COLS]
    return ("SELECT column_name, null_count, ROUND(CAST(null_count AS DOUBLE) * 100.0 / n, 4) AS null_pct FROM ("
            + " UNION ALL ".join(parts) + ") WHERE null_count > 0")


@register("profile_nulls", sql(_nulls_sql(), "merged"))
def profile_nulls(spark, sf):
    """Null count and percentage per column, only columns with nulls (one
    aggregation pass, then a narrow stack)."""
    df = tables.merged(spark, sf)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in _MERGED_COLS])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(c)).alias("null_count"),
                             F.col("_n").alias("_n")) for c in _MERGED_COLS])
    out = agg.select(F.inline(arr)).filter(F.col("null_count") > 0)
    return out.select("column_name", "null_count", r4(F.col("null_count") * 100.0 / F.col("_n")).alias("null_pct"))


@register("profile_target", sql("""
SELECT Store, ROUND(AVG(Sales), 4) AS mean_sales, MIN(Sales) AS min_sales, MAX(Sales) AS max_sales,
       ROUND(STDDEV_SAMP(Sales), 4) AS std_sales
FROM processed GROUP BY Store""", "processed"))
def profile_target(spark, sf):
    """Mean / min / max / sample std of Sales per store (open days)."""
    return tables.processed(spark, sf).groupBy("Store").agg(
        r4(F.avg("Sales")).alias("mean_sales"), F.min("Sales").alias("min_sales"),
        F.max("Sales").alias("max_sales"), r4(F.stddev_samp("Sales")).alias("std_sales"))


@register("avg_by_dow", sql("""
SELECT Store, DayOfWeek, ROUND(AVG(Sales), 4) AS avg_sales FROM processed GROUP BY Store, DayOfWeek""", "processed"))
def avg_by_dow(spark, sf):
    """Mean Sales per store and weekday."""
    return tables.processed(spark, sf).groupBy("Store", "DayOfWeek").agg(r4(F.avg("Sales")).alias("avg_sales"))


@register("avg_by_promo", sql("""
SELECT Store, ROUND(COALESCE(AVG(CASE WHEN Promo = 0 THEN Sales END), 0), 4) AS avg_no_promo,
       ROUND(COALESCE(AVG(CASE WHEN Promo = 1 THEN Sales END), 0), 4) AS avg_promo
FROM processed GROUP BY Store""", "processed"))
def avg_by_promo(spark, sf):
    """Mean Sales without / with promo per store; a missing group reads 0."""
    s = F.col("Sales")
    return tables.processed(spark, sf).groupBy("Store").agg(
        r4(F.coalesce(F.avg(F.when(F.col("Promo") == 0, s)), F.lit(0.0))).alias("avg_no_promo"),
        r4(F.coalesce(F.avg(F.when(F.col("Promo") == 1, s)), F.lit(0.0))).alias("avg_promo"))


@register("avg_by_month", sql("""
SELECT Store, Month, ROUND(AVG(Sales), 4) AS avg_sales FROM processed GROUP BY Store, Month""", "processed"))
def avg_by_month(spark, sf):
    """Mean Sales per store and month."""
    return tables.processed(spark, sf).groupBy("Store", "Month").agg(r4(F.avg("Sales")).alias("avg_sales"))
