"""op12: quality by compression. No SQL compresses with dictionaries; the tests hold it against plain Python and held-out labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import compressmodel
from .tables import documents

#: Scores from here on are predicted to be label 1.
THRESHOLD = 0.3


def op12_quality_classifier(spark, sf_dir):
    """The quality score of every whole document, learned from the labels that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~compressmodel.held_out(F.col("doc_id")))
    out = compressmodel.scored(docs, compressmodel.train(docs, labels))
    return out.select("doc_id", compressmodel.held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
