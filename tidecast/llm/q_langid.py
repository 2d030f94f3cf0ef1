"""op4: language identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import langid
from .tables import documents


def op4_language_id(spark, sf_dir):
    """The language of every whole document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir).withColumn("held_out", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.filter("doc_id IS NOT NULL AND NOT held_out").select("lang", "text"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model)
