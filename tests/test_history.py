"""The forecast history: deletes touch the days of the deleted ids only."""

import os

from tidecast.operators import history as hs
from tidecast.session import scratch_path

COLS = ("id bigint, store_id int, total_predicted_sales bigint, average_predicted_sales bigint, stockout_risk string, "
        "reorder_needed boolean, created_at timestamp_ntz, created_date date")


def _log(spark):
    import datetime as dt
    rows = [(i, 1, i, i, "low", False, dt.datetime(2024, 1, 1 + i // 3, i % 3), dt.date(2024, 1, 1 + i // 3)) for i in range(12)]
    return hs.log_append(spark.createDataFrame(rows, COLS), scratch_path(spark, "log"))


def _files(path):
    root = path.replace("file:", "")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_delete_keeps_untouched_days(spark):
    path = _log(spark)
    before = _files(path)
    left = hs.log_delete(spark, path, [4, 5, 99])
    assert sorted(r.id for r in left.collect()) == [0, 1, 2, 3, 6, 7, 8, 9, 10, 11]
    assert _files(path) == before
    read = {os.path.basename(os.path.dirname(f)) for f in left.inputFiles() if path.replace("file:", "") in f}
    assert "created_date=2024-01-02" not in {d for d in read} or len(left.filter("created_date = '2024-01-02'").collect()) == 1


def test_recent_reads_only_the_newest_days(spark, capsys):
    log = spark.read.parquet(_log(spark))
    recent = hs.log_recent(log, 4)
    assert [r.id for r in recent.collect()] == [11, 10, 9, 8]
    capsys.readouterr()
    recent.explain("formatted")
    assert "PartitionFilters: [isnotnull(created_date" in capsys.readouterr().out
    assert hs.log_recent(log.filter("false"), 4).count() == 0
