"""Report documents as files: one pretty JSON file per row, published when the job commits.

A Python data source (format ``tidecast_reports``). A task writes its files under a staging
folder, in a folder of its own attempt; the commit drops what failed attempts left and renames the staging folder to the
path, in one step. A job that fails leaves no path. Rows: name, document (JSON text).
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class _Written(WriterCommitMessage):
    attempt: str
    files: int


def _place(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^(file:)?/+", "file:///", path))


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.staging = path.rstrip("/"), f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator) -> _Written:
        from pyspark import TaskContext
        attempt, n = f"part-{TaskContext.get().taskAttemptId()}", 0
        store, root = _place(f"{self.staging}/{attempt}")
        store.create_dir(root, recursive=True)
        for row in iterator:
            name = re.sub(r"[^A-Za-z0-9._-]", "_", row["name"])
            with store.open_output_stream(f"{root}/{name}.json") as out:
                out.write(json.dumps(json.loads(row["document"]), indent=2, ensure_ascii=False).encode())
            n += 1
        return _Written(attempt, n)

    def commit(self, messages) -> None:
        from pyarrow import fs
        store, staging = _place(self.staging)
        _, final = _place(self.path)
        if store.get_file_info(final).type != fs.FileType.NotFound:
            raise FileExistsError(self.path)
        whole = {m.attempt for m in messages if m is not None}
        store.create_dir(staging, recursive=True)
        for entry in store.get_file_info(fs.FileSelector(staging)):
            if entry.base_name not in whole:
                store.delete_dir(entry.path)
        store.move(staging, final)

    def abort(self, messages) -> None:
        from pyarrow import fs
        store, staging = _place(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class ReportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidecast_reports"

    def writer(self, schema, overwrite) -> _Writer:
        return _Writer(self.options["path"])


def write_reports(df: DataFrame, path: str) -> str:
    """``df`` (name, document) as one pretty file per row under ``path`` (new)."""
    from ..operators.workers import ship
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(ReportSource)
    df.select("name", "document").write.format("tidecast_reports").mode("append").save(path)
    return path
