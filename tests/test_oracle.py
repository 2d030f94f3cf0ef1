"""Every registered query vs its DuckDB oracle SQL (row count, schema, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import SPARK2DUCK, digest  # noqa: E402
from paths import SF_SMALL  # noqa: E402
from tidecast.plans import catalog  # noqa: E402

SQL = catalog.oracle_sql()
ALL = catalog.queries()


def test_every_query_is_registered_with_sql_or_rows_only():
    rows_only = sorted(set(ALL) - set(SQL))
    assert rows_only == ["champion_models"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = ALL[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    stypes = {f.name: SPARK2DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dtypes = dict(zip(dcols, [str(d[1]) for d in cur.description]))
    assert stypes == dtypes
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
