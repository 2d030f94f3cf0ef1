"""Shared-folder tables and small Spark helpers of the subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: A table is broadcast up to so many rows and bytes (its rows as JSON text), else joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a table has at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes; reads one row more at most."""
    head = df.limit(BROADCAST_ROWS + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("size"))
    n, size = head.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it was measured to fit, else unchanged, so that Spark plans a shuffle join."""
    return F.broadcast(df) if fits_broadcast(df) else df


def free(name: str, *frames: DataFrame) -> str:
    """The name, with underscores before it until no column of the frames has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage on storage that every executor sees: a lost executor
    re-reads files, nothing is recomputed from the raw scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    # shuffle files of finished steps go when the JVM finds their plans unused; ask it to look
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application (``addPyFile``),
    so that functions which run inside tasks can be imported wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_tidecast_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tidecast-ship-")) / "tidecast_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._tidecast_shipped = True


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
