"""op6: quality rules with cross-document line frequency."""

from __future__ import annotations

from . import quality
from .tables import documents

R = quality.Rules()


def op6_quality_rules(spark, sf_dir):
    """Base counts, base verdict and the line-frequency verdict of every document."""
    return quality.judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words")


SQL = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
           FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {R.window - 1}], ' ') AS g
        FROM t, unnest(range(1, len(w) - {R.window - 2})) AS u(i) WHERE len(w) >= {R.window}),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, unnest(range(0, {R.window})) AS u(k) GROUP BY 1),
ln AS (SELECT doc_id, source, text, j, string_split(text, chr(10))[j] AS l
       FROM t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(j)),
wl AS (SELECT *, array_to_string(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\\x20\\x09-\\x0D]+'), ' ') AS norm
       FROM ln WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM wl GROUP BY 1),
freq AS (SELECT source, norm, count(DISTINCT text) AS n, min(doc_id) AS first_doc FROM wl GROUP BY 1, 2),
host AS (SELECT source, count(DISTINCT text) AS n FROM t GROUP BY 1),
over_l AS (SELECT f.source, f.norm, f.first_doc FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source
           WHERE f.n > {R.line_docs} AND f.n > h.n * {R.line_share}),
gone AS (SELECT w.doc_id, sum(len(string_split(w.norm, ' '))) AS n FROM wl w JOIN over_l o
         ON w.source IS NOT DISTINCT FROM o.source AND w.norm = o.norm AND w.doc_id <> o.first_doc GROUP BY 1),
facts AS (
  SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(t.w, '')) AS BIGINT) AS word_chars,
         CAST(length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM t LEFT JOIN dup ON dup.doc_id = t.doc_id LEFT JOIN cov ON cov.doc_id = t.doc_id LEFT JOIN gone ON gone.doc_id = t.doc_id),
base AS (SELECT *, (n_words < {R.min_words} OR n_repeat_words * 100 > n_words * {R.repeat_share}) AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < {R.min_words}
        OR n_words - n_removed_words < n_words * {R.left_share}))) AS kept, n_removed_words
FROM base
"""
