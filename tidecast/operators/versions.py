"""The forecast history as a versioned table.

    root/data/<write>/part-*.parquet      rows, never changed
    root/manifests/<write>/*.parquet      the files of one version: path, rows, range of id and created_at
    root/versions/00000000042             one line: the manifest of version 42

A version is a manifest; the newest number is current. A writer adds data files, writes the next manifest, and
commits by creating the file of the next number, which only one writer can do. The loser of a race reads
the newer version and tries again: an append adds its files to it, a delete starts anew from it. Nothing is
overwritten, so a reader of a version sees it whole whatever happens meanwhile, and a task or job
that fails leaves files that no version names.

Files hold ranges of (day, id), have bloom filters on id, and the manifest knows their ranges: a point lookup
opens only the files that can hold the id, the newest rows are found from the ranges of ``created_at``.
The manifest is a table: it is filtered and joined by Spark, the driver sees the paths of the files it reads.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, n bigint, min_id bigint, max_id bigint, min_created timestamp_ntz, max_created timestamp_ntz"


class Conflict(Exception):
    """Another writer has committed the version."""


class VersionedLog:
    """``rows_per_file``: rows of a data file at most; ``retries``: commits tried before giving up."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = 1_000_000, retries: int = 50):
        self.spark, self.root, self.rows_per_file, self.retries = spark, root.rstrip("/"), rows_per_file, retries

    # ---- file names and the commit ----------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/versions")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []

    def latest(self) -> int:
        """The newest version, 0 for a table without one."""
        return max(self.versions(), default=0)

    def _manifest_path(self, version: int) -> str:
        return self.spark.read.text(f"{self.root}/versions/{version:011d}").first()[0]

    def _commit(self, version: int, manifest: str) -> None:
        """Create the file of the version, or fail if it is there. The content is complete before the name appears."""
        fs, _ = self._fs(self.root)
        final, draft = f"{self.root}/versions/{version:011d}", f"{self.root}/versions/.draft-{uuid.uuid4().hex}"
        _, d = self._fs(draft)
        out = fs.create(d)
        out.write(bytearray(manifest.encode()))
        out.close()
        if fs.getScheme() == "file":     # a local rename would replace the file: a hard link does not
            plain = [fs.makeQualified(self._fs(x)[1]).toUri().getPath() for x in (draft, final)]
            try:
                os.link(*plain)
            except FileExistsError as e:
                raise Conflict(version) from e
            finally:
                fs.delete(d, False)
            return
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(d.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(d, self._fs(final)[1], none)
        except Exception as e:
            fs.delete(d, False)
            if fs.exists(self._fs(final)[1]):
                raise Conflict(version) from e
            raise

    # ---- manifests -------------------------------------------------------------------------------------

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._manifest_path(version))

    def _write(self, rows: DataFrame) -> DataFrame:
        """New data files of ``rows``; their manifest entries."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        (rows.repartitionByRange("created_date", "id").sortWithinPartitions("created_date", "id").write
         .option("parquet.bloom.filter.enabled#id", "true").option("maxRecordsPerFile", self.rows_per_file).parquet(path))
        back = self.spark.read.schema(rows.schema).parquet(path)
        return back.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
            F.min("created_at").alias("min_created"), F.max("created_at").alias("max_created"))

    def _publish(self, version: int, entries: DataFrame) -> int:
        path = f"{self.root}/manifests/{uuid.uuid4().hex}"
        entries.select(*[f.split()[0] for f in MANIFEST.split(", ")]).coalesce(1).write.parquet(path)
        fs, p = self._fs(f"{self.root}/versions")
        fs.mkdirs(p)
        self._commit(version, path)
        return version

    def _read(self, paths: Sequence[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @staticmethod
    def _paths(entries: DataFrame) -> list[str]:
        return sorted(r.path for r in entries.select("path").collect())

    # ---- operations ----------------------------------------------------------------------------------------

    def append(self, rows: DataFrame) -> int:
        """Add rows as new files; the version that holds them."""
        new = self._write(rows).collect()                         # one entry per file of this append
        new = self.spark.createDataFrame(new, MANIFEST)
        for _ in range(self.retries):
            base = self.latest()
            try:
                return self._publish(base + 1, self.manifest(base).unionByName(new))
            except Conflict:
                continue
        raise Conflict(f"no commit after {self.retries} tries")

    def delete(self, ids: Sequence[int] | DataFrame, schema) -> int:
        """Remove ids: only files that hold one are written anew, without them. The version without the ids."""
        ids = ids if isinstance(ids, DataFrame) else self.spark.createDataFrame([(int(i),) for i in ids], "id bigint")
        ids = ids.select("id").distinct()
        lo, hi = ids.agg(F.min("id"), F.max("id")).first()
        for _ in range(self.retries):
            base = self.latest()
            entries = self.manifest(base)
            may = entries.filter((F.col("max_id") >= F.lit(lo)) & (F.col("min_id") <= F.lit(hi)))
            paths = self._paths(may)
            if not paths:
                return base
            held = self._read(paths, schema).select("id", F.col("_metadata.file_path").alias("path"))
            hit = [r.path for r in held.join(ids, "id", "left_semi").select("path").distinct().collect()]
            if not hit:
                return base
            kept = self._read(hit, schema).join(ids, "id", "left_anti")
            new = self.spark.createDataFrame(self._write(kept).collect(), MANIFEST)
            try:
                return self._publish(base + 1, entries.filter(~F.col("path").isin(hit)).unionByName(new))
            except Conflict:
                continue
        raise Conflict(f"no commit after {self.retries} tries")

    def read(self, schema, version: int | None = None) -> DataFrame:
        """All rows of a version (the newest if none is given)."""
        return self._read(self._paths(self.manifest(version)), schema)

    def get(self, log_id: int, schema, version: int | None = None) -> DataFrame:
        """The row of an id: opens only files whose id range holds it (their bloom filters skip the rest)."""
        may = self.manifest(version).filter((F.col("min_id") <= log_id) & (F.col("max_id") >= log_id))
        return self._read(self._paths(may), schema).filter(F.col("id") == log_id)

    def recent(self, schema, limit: int = 20, version: int | None = None) -> DataFrame:
        """The newest rows (id breaks ties), from the files that can hold them: those that reach back no further than
        the start of the newest files which together hold ``limit`` rows."""
        entries, have, since = self.manifest(version), 0, None
        for r in entries.orderBy(F.desc("min_created")).select("min_created", "n").limit(limit).collect():
            have, since = have + r.n, r.min_created
            if have >= limit:
                break
        may = entries if since is None or have < limit else entries.filter(F.col("max_created") >= F.lit(since))
        return self._read(self._paths(may), schema).orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)
