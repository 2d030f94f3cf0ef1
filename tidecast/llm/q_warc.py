"""op7: pages written to ZIP-packaged WARC archives and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import warc


def op7_warc(spark, sf_dir):
    """Round trip of every page: payload size and digest, record type and revisit target."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast(pages.schema["page_id"].dataType)
    return warc.read_archives(warc.write_archives(pages)).select(
        number("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first_page FROM p WHERE n >= {warc.MIN_REVISIT} GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first_page < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_page < page_id THEN f.first_page END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d AND p.n >= {warc.MIN_REVISIT}
"""
