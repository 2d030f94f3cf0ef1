"""Run every registered query in Spark and its oracle SQL in DuckDB and
compare row count, schema and an order-insensitive value hash.

    python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

EXACT = os.environ.get("EXACT") == "1"   # compare doubles bit for bit
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v + 0.0) if EXACT else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


SPARK2DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP",
              "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from tidecast.plans import catalog
    from tidecast.session import get_spark
    spark = get_spark()
    con = duck(sf_dir)
    qs, sqls = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = {f.name: SPARK2DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                      for f in sdf.schema.fields}
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS-ONLY  {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[name])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
            dtypes = dict(zip(dcols, [str(d[1]) for d in cur.description]))
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL   {name}: {str(e).splitlines()[0][:300]}")
            bad += 1
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        else:
            tmis = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
            if tmis:
                problems.append(f"types {tmis}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not problems:
            hs, ls = digest(scols, srows)
            hd, ld = digest(dcols, drows)
            if hs != hd:
                diff_s = sorted(set(ls) - set(ld))[:3]
                diff_d = sorted(set(ld) - set(ls))[:3]
                problems.append(f"values differ spark-only={diff_s} duck-only={diff_d}")
        if problems:
            bad += 1
            print(f"MISMATCH   {name}: " + " | ".join(problems)[:1500])
        else:
            print(f"OK         {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
