"""op2: near-duplicate groups by circulant MinHash."""

from __future__ import annotations

from . import neardup
from .tables import documents

CONTRACT = neardup.Similar(shingle=3, percent=85)


def op2_minhash_near_dedup(spark, sf_dir):
    """The group of every document over three-word shingles at similarity 0.85."""
    return neardup.groups(documents(spark, sf_dir), CONTRACT).drop("text_key")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
       FROM t, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.doc_id = c.doc_id
"""
