"""op3: benchmark decontamination by a positional inverted index."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate
from .tables import documents

WINDOW = 10
#: Words that a proximity match may be apart from the window's, in all.
SLOP = 2


def op3_benchmark_decontamination(spark, sf_dir):
    """Words of every document inside an occurrence of a benchmark window, the items found, and the items
    found within two words of a window (proximity)."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    r = decontaminate.report(documents(spark, sf_dir), bench, WINDOW, SLOP)
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                    F.size("near_items").cast("bigint").alias("n_near_items"),
                    F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"))


_W = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
      r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SQL = f"""
WITH d AS (SELECT doc_id, {_W} AS w FROM documents),
b AS (SELECT item_id, {_W} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g, least(len(w), {WINDOW}) AS n
       FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS u(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
hit AS (SELECT doc_id, i, n, g FROM (
          SELECT d.doc_id, i, lens.n, array_to_string(d.w[i:i + lens.n - 1], ' ') AS g
          FROM d, lens, unnest(range(1, len(d.w) - lens.n + 2)) AS u(i) WHERE len(d.w) >= lens.n)
        WHERE g IN (SELECT g FROM bw)),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, unnest(range(0, hit.n)) AS u(k) GROUP BY 1),
its AS (SELECT h.doc_id, count(DISTINCT bw.item_id) AS n,
               sha256(array_to_string(list_sort(list(DISTINCT CAST(bw.item_id AS VARCHAR))), ',')) AS s
        FROM hit h JOIN bw ON bw.g = h.g AND bw.n = h.n GROUP BY 1),
nw AS (SELECT DISTINCT w[i:i + {WINDOW - 1}] AS ws FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS u(i) WHERE len(w) > 0),
place AS (SELECT ws, ws[i] AS term, i - 1 AS at FROM nw, unnest(range(1, len(ws) + 1)) AS u(i)),
tok AS (SELECT doc_id, w[i] AS term, i - 1 AS pos FROM d, unnest(range(1, len(w) + 1)) AS u(i) WHERE w[i] IN (SELECT term FROM place)),
often AS (SELECT term, count(*) AS n FROM tok GROUP BY 1),
anchor AS (SELECT p.ws, arg_min(p.term, coalesce(o.n, 0)) AS term, arg_min(p.at, coalesce(o.n, 0)) AS at
           FROM place p LEFT JOIN often o ON o.term = p.term GROUP BY 1),
cand AS (SELECT DISTINCT a.ws, t.doc_id, t.pos - a.at - k AS low FROM anchor a JOIN tok t ON t.term = a.term, range(0, {SLOP + 1}) r(k)),
tried AS (SELECT c.ws, c.doc_id, list_reduce(list_prepend([CAST(0 AS BIGINT)], [[CAST(i AS BIGINT)] FOR i IN range(0, len(c.ws))]),
            lambda acc, x: CASE WHEN acc[1] < 0 THEN acc ELSE coalesce(list_append(acc, list_filter(range(c.low + x[1], c.low + x[1] + {SLOP + 1}),
              lambda p: p >= 0 AND d.w[p + 1] = c.ws[x[1] + 1] AND NOT list_contains(acc[2:], p))[1]), [CAST(-1 AS BIGINT)]) END) AS used
          FROM cand c JOIN d ON d.doc_id = c.doc_id),
near AS (SELECT t.doc_id, count(DISTINCT i.item_id) AS n, sha256(array_to_string(list_sort(list(DISTINCT CAST(i.item_id AS VARCHAR))), ',')) AS s
         FROM (SELECT DISTINCT ws, doc_id FROM tried WHERE used[1] = 0 AND len(used) = len(ws) + 1 AND NOT list_contains(list_transform(used, lambda u: u IS NULL), true)) t
         JOIN (SELECT DISTINCT item_id, w[i:i + {WINDOW - 1}] AS ws FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS u(i) WHERE len(w) > 0) i
           ON i.ws = t.ws GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, coalesce(its.s, sha256('')) AS items_sha256,
       coalesce(cov.n, 0) > 0 AS contaminated, CAST(coalesce(near.n, 0) AS BIGINT) AS n_near_items,
       coalesce(near.s, sha256('')) AS near_items_sha256
FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id LEFT JOIN near ON near.doc_id = d.doc_id
"""
