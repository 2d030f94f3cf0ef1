"""op5: substring dedup by recompression."""

from __future__ import annotations

from . import substrings
from .tables import documents

WINDOW = 50


def op5_substring_dedup(spark, sf_dir):
    """Every document without the words of 50-word windows that a smaller doc_id has too."""
    return substrings.deduplicated(documents(spark, sf_dir), WINDOW).drop("kept_text")


SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS g
        FROM t, unnest(range(1, len(w) - {WINDOW - 2})) AS u(i) WHERE len(w) >= {WINDOW}),
rep AS (SELECT doc_id, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM rep, unnest(range(0, {WINDOW})) AS u(k)),
word AS (SELECT doc_id, p, w[p] AS x FROM t, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT word.doc_id, count(*) AS n, string_agg(word.x, ' ' ORDER BY word.p) AS s
         FROM word ANTI JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY 1)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(len(t.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM t LEFT JOIN kept ON kept.doc_id = t.doc_id
"""
