"""Explicit schemas at every boundary."""

from pyspark.sql import types as T

SALES_DAILY = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Sales", T.LongType()),
    T.StructField("Customers", T.LongType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
])

STORE_DIM = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("CompetitionOpenSinceMonth", T.IntegerType()),
    T.StructField("CompetitionOpenSinceYear", T.IntegerType()),
    T.StructField("Promo2", T.IntegerType()),
    T.StructField("Promo2SinceWeek", T.IntegerType()),
    T.StructField("Promo2SinceYear", T.IntegerType()),
])

PRODUCT_DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product", T.StringType()),
    T.StructField("units_sold", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("stock", T.LongType()),
    T.StructField("promotion", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

# A forecast request as it arrives (strings for dates: validated later).
REQUEST = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("Store", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("forecast_days", T.IntegerType()),
    T.StructField("forecast_open_days_only", T.BooleanType()),
    T.StructField("promo_dates", T.ArrayType(T.StringType())),
    T.StructField("school_holiday_dates", T.ArrayType(T.StringType())),
    T.StructField("current_stock", T.LongType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("reorder_lead_time_days", T.IntegerType()),
    T.StructField("safety_stock_percentage", T.DoubleType()),
])

PREDICTION = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("sample_index", T.IntegerType()),
    T.StructField("forecast_day", T.IntegerType()),
    T.StructField("actual_sales", T.DoubleType()),
    T.StructField("predicted_sales", T.DoubleType()),
    T.StructField("absolute_error", T.DoubleType()),
    T.StructField("percentage_error", T.DoubleType()),
])


# Input tables of the testdata adapter (only the columns the adapter reads;
# parquet resolves columns by name, so a narrower schema is also the pruning).
LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()), T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])
SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.IntegerType())])
NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType())])
PART = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_type", T.StringType()),
                     T.StructField("p_size", T.IntegerType())])
INPUTS = {"lineitem": LINEITEM, "supplier": SUPPLIER, "nation": NATION, "part": PART}
