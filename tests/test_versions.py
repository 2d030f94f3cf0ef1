"""The versioned history: races, whole versions, files read by a lookup."""

import datetime as dt
import threading

import pytest

from tidecast.operators import versions as vs
from tidecast.session import scratch_path

COLS = "id bigint, store_id int, created_at timestamp_ntz, created_date date, request_payload string"


def rows(spark, ids):
    data = [(i, i % 3, dt.datetime(2024, 1, 1 + i // 50, i % 24), dt.date(2024, 1, 1 + i // 50), f"text {i}") for i in ids]
    return spark.createDataFrame(data, COLS)


@pytest.fixture
def log(spark):
    return vs.VersionedLog(spark, scratch_path(spark, "versioned"), rows_per_file=40)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_append_delete_and_old_versions(spark, log):
    schema = rows(spark, [1]).schema
    assert log.latest() == 0 and log.read(schema).count() == 0 and log.get(1, schema).count() == 0
    assert log.append(rows(spark, range(200))) == 1
    assert log.append(rows(spark, range(200, 260))) == 2
    assert log.delete([5, 210, 999], schema) == 3
    assert log.delete([999], schema) == 3                          # nothing to remove, no new version
    assert ids(log.read(schema)) == [i for i in range(260) if i not in (5, 210)]
    assert ids(log.read(schema, 2)) == list(range(260)) and ids(log.read(schema, 1)) == list(range(200))
    kept = {r.path for r in log.manifest(2).collect()} & {r.path for r in log.manifest(3).collect()}
    assert len(kept) == log.manifest(2).count() - 2                # one file per deleted id was written anew
    log.delete(rows(spark, range(260)).select("id"), schema)
    assert log.read(schema).count() == 0 and log.recent(schema, 5).count() == 0


def test_point_lookup_reads_one_of_many_files(spark, log):
    df = rows(spark, range(400))
    log.append(df)
    assert log.manifest().count() >= 8
    found = log.get(333, df.schema)
    assert [r.request_payload for r in found.collect()] == ["text 333"] and len(found.inputFiles()) == 1
    assert log.get(-1, df.schema).count() == 0


def test_recent_reads_the_newest_files(spark, log):
    df = rows(spark, range(400))
    log.append(df)
    log.append(rows(spark, range(400, 410)))
    want = sorted(((r.created_at, r.id) for r in df.collect()), reverse=True)
    every = sorted(((r.created_at, r.id) for r in log.read(df.schema).collect()), reverse=True)
    for n in (1, 7, 60, 1000):
        got = log.recent(df.schema, n)
        assert [(r.created_at, r.id) for r in got.collect()] == every[:n]
    assert len(log.recent(df.schema, 3).inputFiles()) < log.manifest().count() and want


def test_writers_race(spark, log):
    """Three appends and a delete at once: each ends in a version of its own, none is lost, every version is whole."""
    df = rows(spark, range(100))
    log.append(df)
    done, gate = [], threading.Barrier(4)

    def run(step):
        other = vs.VersionedLog(spark, log.root, rows_per_file=40)
        gate.wait()
        done.append(step(other))
    steps = [lambda w, k=k: w.append(rows(spark, range(100 * k, 100 * k + 30))) for k in (1, 2, 3)]
    steps.append(lambda w: w.delete([3, 60], df.schema))
    threads = [threading.Thread(target=run, args=(s,)) for s in steps]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == [2, 3, 4, 5] and log.versions() == [1, 2, 3, 4, 5]
    want = [i for i in range(100) if i not in (3, 60)] + [i for k in (1, 2, 3) for i in range(100 * k, 100 * k + 30)]
    assert ids(log.read(df.schema)) == want
    sizes = [log.read(df.schema, v).count() for v in log.versions()]
    assert sorted(abs(b - a) for a, b in zip(sizes, sizes[1:])) == [2, 30, 30, 30]


def test_a_version_is_committed_once(spark, log):
    log.append(rows(spark, range(10)))
    with pytest.raises(vs.Conflict):
        log._commit(1, "elsewhere")
    assert ids(log.read(rows(spark, [1]).schema)) == list(range(10))


def test_an_append_that_fails_leaves_no_version(spark, log):
    from pyspark.sql import functions as F
    log.append(rows(spark, range(10)))
    bad = rows(spark, range(10, 20)).withColumn("request_payload", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception):
        log.append(bad)
    assert log.latest() == 1 and log.read(rows(spark, [1]).schema).count() == 10
