"""The driver contract: entry() on sf0.001, stable schema, rows > 0."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    m = _entry_module()
    a, b = m.entry(spark), m.entry(spark)
    assert a.schema == b.schema
    assert a.schema.simpleString() == ("struct<Store:int,forecast_day:int,mae:double,rmse:double,mape:double,"
                                       "n_points:bigint>")
    assert a.count() > 0


def test_every_oracle_key_is_a_query():
    m = _entry_module()
    assert set(m.oracle_sql()) <= set(m.queries())
    assert all(callable(f) for f in m.queries().values())
