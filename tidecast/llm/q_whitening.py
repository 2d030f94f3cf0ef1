"""op13: embedding whitening. Eigenvectors are beyond plain SQL; the tests hold the query against numpy on whole matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import whitening


def op13_embedding_whitening(spark, sf_dir):
    """The first eight whitened components of every vector, fitted on all of them."""
    out = whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("deviation", F.col("deviation").cast("bigint"))
