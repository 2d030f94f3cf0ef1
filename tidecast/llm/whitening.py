"""Embedding whitening by weighted multiplicity covariance.

Method. Every entry c of a vector becomes the integer x = floor(``SCALE`` c) +
``OFFSET``. Equal x vectors are grouped; a group's size is its weight (``weights``
= "one" fits every distinct vector once instead). The weighted sums S and the weight n
give the mean; centred vectors, weighted, are multiplied block by block into the
covariance (divisor n). Its unit eigenvectors by falling eigenvalue are the
components. Each distinct vector is whitened once and the result is joined back to
all rows that hold it.

Plan. Grouping is one aggregation, partial before its shuffle: a vector that a third
of all rows share arrives once per task. The distinct table is stored; sums and matrix
blocks are per-task Arrow passes over it whose dim + dim * (dim + 1) / 2 numbers Spark adds
up by index. Only these sums, of a size set by the dimension and not by the rows,
reach the driver, which solves the dim x dim eigenproblem. For the join back a vector that
holds more than a ``SALTS``-th of all rows is split: there are at most ``SALTS`` such
vectors, whose keys (no vectors) are broadcast, and both sides carry the split number.

Defined results. A null vector and one with a null, NaN or infinite entry, or an
entry whose x is beyond 2**52, is dropped and not fitted. The dimension is that of most
remaining rows (ties: the larger); rows of another length are dropped like null
vectors. Repeated rows and rows with a null id are rows like others, each fitted and
returned. A component without variance (eigenvalue under 1e-12 of the largest) cannot be
whitened and is left out, so fewer than ``components`` rows per vector can follow; one
vector alone, equal vectors, empty vectors and an empty table give no rows. Equal
eigenvalues: the components are some orthonormal basis, the same for all rows. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import arrow_map, stored

SCALE = 1024.0
OFFSET = 100_000
COMPONENTS = 8
#: A vector with more than this part of all rows is split in the join back.
SALTS = 1024
#: Numbers of one numpy block.
BLOCK = 1 << 20
#: Eigenvalues under this part of the largest one count as zero.
RANK = 1e-12

SCHEMA = ("vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
          "identity_error double")


def integer_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, x) of the rows whose vector has finite entries only."""
    v = F.col(f"`{vector_column}`")
    fits = F.forall(v, lambda c: F.abs(c.cast("double")) < F.lit(2.0 ** 52 / SCALE))
    return df.filter(fits).select(
        F.col(f"`{id_column}`").alias("vec_id"),
        F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("bigint")).alias("x"))


def _dimension(x: DataFrame) -> int:
    top = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return top[0].d if top else 0


def _blocks(batch: pa.RecordBatch, column: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size with their vectors as a matrix."""
    step = max(1, BLOCK // max(dim, 1))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact(a: np.ndarray, bound: int) -> np.ndarray:
    """As 64-bit integers if results up to ``bound`` fit, else as Python integers."""
    return a if bound < 2 ** 62 else a.astype(object)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact."""
    top = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0)) * 2
    return _exact(x, top) * n - np.array(sums, dtype=np.int64 if top < 2 ** 62 else object)


def _task_sums(column: str, dim: int, kind: str):
    """Per task: (i, sum of weight * entry i)."""
    def run(batches):
        total = [0] * dim
        for b in batches:
            for part, m in _blocks(b, column, dim):
                w = part.column("w").to_numpy(zero_copy_only=False)
                if m.dtype == np.int64:
                    m = _exact(m, int(np.abs(m).max(initial=0)) * int(w.sum()))
                    got = (m * w[:, None]).sum(axis=0).tolist()
                else:
                    got = (w.astype(float) @ m).tolist()
                total = [a + g for a, g in zip(total, got)]
        as_type = pa.decimal128(38, 0) if kind == "decimal(38,0)" else pa.float64()
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total, as_type)], ["i", "s"])
    return run, f"i int, s {kind}"


def _task_products(column: str, dim: int, centre):
    """Per task: (i, j, sum of weight * centred entry i * centred entry j) for i <= j."""
    def run(batches):
        g = np.zeros((dim, dim))
        for b in batches:
            for part, m in _blocks(b, column, dim):
                c = centre(m)
                g += (c * part.column("w").to_numpy(zero_copy_only=False)[:, None]).T @ c
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(g[i, j])], ["i", "j", "s"])
    return run, "i int, j int, s double"


def _sums(df: DataFrame, column: str, dim: int, kind: str) -> list:
    rows = arrow_map(df.select("w", column), *_task_sums(column, dim, kind)).groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = [0] * dim
    for r in rows:
        out[r.i] = int(r.s) if kind.startswith("decimal") else r.s
    return out


def _covariance(df: DataFrame, column: str, dim: int, n: int, centre) -> np.ndarray:
    rows = arrow_map(df.select("w", column), *_task_products(column, dim, centre)).groupBy("i", "j").agg(F.sum("s").alias("s"))
    v = np.zeros((dim, dim))
    for r in rows.collect():
        v[r.i, r.j] = v[r.j, r.i] = r.s / n
    return v


def _whitener(n: int, sums: list[int], basis: np.ndarray, dim: int):
    """(key, w, deviation, z): the exact squared deviation and the whitened entries of each distinct vector."""
    def run(batches):
        for b in batches:
            for part, x in _blocks(b, "x", dim):
                v = _scaled(x, n, sums)
                e = _exact(v, dim * int(np.abs(v).max(initial=0)) ** 2)
                dev = (e * e).sum(axis=1)
                z = (v.astype(float) / n) @ basis
                k = basis.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("w"), pa.array([int(d) for d in dev], pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(np.arange(0, len(z) * k + 1, k, dtype=np.int32), pa.array(z.ravel()))],
                    ["key", "w", "deviation", "z"])
    return run, "key string, w bigint, deviation decimal(38,0), z array<double>"


def whitened(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
             components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """One row per remaining row of ``df`` and component, see ``SCHEMA``."""
    if weights not in ("count", "one"):
        raise ValueError("weights: count or one")
    spark = df.sparkSession
    x = integer_vectors(df, id_column, vector_column)
    nothing = spark.createDataFrame([], SCHEMA)
    dim = _dimension(x)
    if not dim:
        return nothing
    x = x.filter(F.size("x") == dim)
    key = F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256).alias("key")
    distinct = stored(x.groupBy("x").agg(F.count(F.lit(1)).alias("rows"))
                      .select(key, "x", "rows", (F.col("rows") if weights == "count" else F.lit(1)).cast("bigint").alias("w")),
                      "whitening_distinct")
    n, total = distinct.agg(F.sum("w"), F.sum("rows")).first()

    sums = _sums(distinct, "x", dim, "decimal(38,0)")
    v = _covariance(distinct, "x", dim, n, lambda m: _scaled(m, n, sums).astype(float) / n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int(np.sum(values > RANK * values[0]))) if values[0] > 0 else 0
    if not k:
        return nothing
    basis = vectors[:, :k] / np.sqrt(values[:k])

    z = stored(arrow_map(distinct.select("key", "x", "w"), *_whitener(n, sums, basis, dim)), "whitening_distinct_whitened")
    mean = np.array(_sums(z, "z", k, "double")) / n
    error = float(np.abs(_covariance(z, "z", k, n, lambda m: m - mean) - np.eye(k)).max())

    # a vector with a large part of all rows is split: its rows by number, its result repeated for each number
    hot = F.broadcast(stored(distinct.filter(F.col("rows") * SALTS > total)
                             .select("key", F.ceil(F.col("rows") * SALTS / total).cast("int").alias("parts")), "whitening_hot"))
    number = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1)).cast("bigint")).cast("int")
    left = x.select("vec_id", key).join(hot, "key", "left").select("vec_id", "key", number.alias("part"))
    right = z.join(hot, "key", "left").select(
        "key", "deviation", "z", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    explained = F.array(*[F.lit(float(e / np.trace(v))) for e in values[:k]])
    return (left.join(right, ["key", "part"])
            .select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")))
