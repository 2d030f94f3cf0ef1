"""Untrusted CSV, report files and scenario tables."""

import json
import os

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators import forecast as fc
from tidecast.operators import validate as vd
from tidecast.plans import requests as rq
from tidecast.plans import tables
from tidecast.session import scratch_path
from tidecast.sources import reports, untrusted

CONTRACT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("day", T.DateType()), T.StructField("x", T.DoubleType()),
                         T.StructField("ok", T.BooleanType())])
LINES = ["id,day,x,ok", "1,2024-02-29,1.5,true", "2,,,", "", "3,2023-02-29,2,false", "x,2024-01-01,1,true", ",2024-01-01,1,true", "4,2024-01-01",
         "5,2024-01-01,1e3,TRUE,more", "9223372036854775808,2024-01-01,.5,no", '6,"2024-01-01",7.,true', "7,2024-1-1,nan,true"]


def test_lines_are_typed_or_rejected(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in LINES], "line string").coalesce(1).write.text(path)
    got = {r.line: (",".join(r.errors), r.id, r.x, r.ok) for r in untrusted.read_untrusted(spark, path, CONTRACT).collect()}
    assert got == {
        LINES[1]: ("", 1, 1.5, True), LINES[2]: ("", 2, None, None), LINES[4]: ("day", None, None, None), LINES[5]: ("id", None, None, None),
        LINES[6]: ("id", None, None, None), LINES[7]: ("columns", None, None, None), LINES[8]: ("columns", None, None, None),
        LINES[9]: ("id,ok", None, None, None), LINES[10]: ("", 6, 7.0, True), LINES[11]: ("day,x", None, None, None)}
    types = {r.column_name: (r.inferred_type, r["cells"], r.empty)
             for r in untrusted.inferred_types(untrusted.read_lines(spark, path, CONTRACT.names), CONTRACT.names).collect()}
    assert types == {"id": ("string", 8, 1), "day": ("string", 8, 1), "x": ("string", 8, 1), "ok": ("string", 8, 1)}


def test_types_of_whole_columns(spark):
    path = scratch_path(spark, "columns")
    rows = ["a,b,c,d,e,f", "1,1,2024-01-01,true,,x", "2,2.5,2024-12-31,false,,1"]
    spark.createDataFrame([(x,) for x in rows], "line string").write.text(path)
    names = rows[0].split(",")
    got = [r.inferred_type for r in untrusted.inferred_types(untrusted.read_lines(spark, path, names), names).collect()]
    assert got == ["bigint", "double", "date", "boolean", "void", "string"]


def _files(path):
    root = path.replace("file:", "")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs)


def test_reports_are_published_whole_or_not_at_all(spark):
    df = spark.range(7).repartition(3).select(F.format_string("report/%d", "id").alias("name"),
                                              F.to_json(F.struct("id", F.lit("é").alias("text"))).alias("document"))
    path = reports.write_reports(df, scratch_path(spark, "reports"))
    docs = {os.path.basename(f): json.load(open(f)) for f in _files(path)}
    assert docs == {f"report_{k}.json": {"id": k, "text": "é"} for k in range(7)} and "\n  " in open(_files(path)[0]).read()
    with pytest.raises(Exception):
        reports.write_reports(df, path)                            # never over a published path
    assert len(_files(path)) == 7
    bad = df.withColumn("document", F.when(F.col("name") == "report/5", "{broken").otherwise(F.col("document")))
    path = scratch_path(spark, "reports")
    with pytest.raises(Exception):
        reports.write_reports(bad, path)
    root = path.replace("file:", "")
    assert not os.path.exists(root) and not [d for d in os.listdir(os.path.dirname(root)) if d.startswith(os.path.basename(root))]


def test_scenarios_as_a_table(spark):
    st = fc.history_state(tables.feature_table(spark, SF_SMALL)).cache()
    listed = rq.scenario_requests(st)
    cols = listed.columns
    want = sorted(map(str, listed.collect()))
    table = rq.scenario_table(spark)
    for bound in (rq.BROADCAST_BYTES, 0):                          # broadcast and salted
        got = rq.attach_scenarios(st, table, broadcast_bytes=bound, salts=4)
        assert sorted(got.columns) == sorted(cols)
        assert sorted(map(str, got.select(*cols).collect())) == want
    one = st.agg(F.min("Store")).first()[0]
    own = rq.scenario_table(spark, rq.SCENARIOS[:2], comparison_id=9, store=one)
    for bound in (rq.BROADCAST_BYTES, 0):
        got = rq.attach_scenarios(st, own, broadcast_bytes=bound, salts=4)
        assert sorted((r.Store, r.position) for r in got.collect()) == [(one, 0), (one, 1)]
    st.unpersist()


def test_many_scenarios_do_not_grow_the_plan(spark):
    st = fc.history_state(tables.feature_table(spark, SF_SMALL))
    many = spark.range(10_000).select(F.lit(None).cast("int").alias("Store"), F.col("id").cast("int").alias("comparison_id"), F.lit(0).alias("position"),
                                      F.lit("n").alias("name"), (F.col("id") % 2 == 0).alias("promo"), F.lit(300).cast("bigint").alias("current_stock"),
                                      F.lit(1.0).alias("unit_price"), F.lit(3).alias("reorder_lead_time_days"), F.lit(.1).alias("safety_stock_percentage"))
    size = lambda df: len(df._jdf.queryExecution().analyzed().toString())
    big, small = rq.attach_scenarios(st, many), rq.attach_scenarios(st, many.limit(5))
    assert size(big) < size(small) + 1000
    rows = rq.attach_scenarios(st, many, broadcast_bytes=0).select("request_id")
    n = st.count() * 10_000
    assert rows.count() == n == rows.distinct().count() == big.count()
    with pytest.raises(ValueError):
        rq.attach_scenarios(st, many.withColumn("position", F.lit(10)))
    with pytest.raises(ValueError):
        rq.scenario_requests(st, comparison_id=rq.MAX_COMPARISONS)


def test_integers_are_exact_to_64_bits(spark):
    bodies = {'{"current_stock": 9007199254740993}': 9007199254740993, '{"current_stock": 9223372036854775807}': 9223372036854775807,
              '{"current_stock": "9007199254740993"}': 9007199254740993, '{"current_stock": 7.0}': 7, '{"current_stock": 1e300}': None,
              '{"current_stock": 9223372036854775808}': None, '{"current_stock": 1e3}': 1000}
    df = vd.parse_requests(spark.createDataFrame([(b,) for b in bodies], "body string"))
    got = {r.body: (r.current_stock, r.type_errors) for r in df.collect()}
    assert got == {b: (v, [] if v is not None else ["current_stock"]) for b, v in bodies.items()}
