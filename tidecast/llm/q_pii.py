"""op9: personal data spans and disclosing terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pii
from .tables import documents

D = pii.Disclosure()


def op9_pii(spark, sf_dir):
    """Counts and positions of personal data in every document, with the terms that disclose it."""
    rows = pii.attached(documents(spark, sf_dir).select("doc_id", "text"), D)
    count = lambda kind: F.size(F.filter("__base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint")
    return rows.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
                       F.sha2(pii.joined("__base"), 256).alias("base_sha256"), pii.joined("__spans").alias("spans"))


_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, {i} AS k, regexp_extract_all(text, '{p}') AS f, regexp_split_to_array(text, '{p}') AS g FROM t"
    for i, (kind, p) in enumerate(_PLAIN.items()))
_AT = ("CAST(list_sum(list_transform({g}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform({f}[1:i - 1], lambda x: length(x))), 0)"
       " AS BIGINT)")
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_MATCHES}),
s0 AS (SELECT doc_id, kind, k, f[i] AS v, regexp_replace(f[i], '[^0-9]', '', 'g') AS dig, {_AT.format(g='g', f='f')} AS s
       FROM m, unnest(range(1, len(f) + 1)) AS u(i)),
base AS (SELECT doc_id, kind, k, v, s, s + length(v) AS e FROM s0 WHERE CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND CAST('0' || right(ltrim(x, '0'), 3) AS INTEGER) <= 255))
    WHEN 'card' THEN length(dig) BETWEEN 14 AND 19 AND list_sum(list_transform(range(0, length(dig)), lambda j:
         CASE WHEN j % 2 = 0 THEN CAST(substr(dig, length(dig) - j, 1) AS INTEGER)
              WHEN CAST(substr(dig, length(dig) - j, 1) AS INTEGER) > 4 THEN 2 * CAST(substr(dig, length(dig) - j, 1) AS INTEGER) - 9
              ELSE 2 * CAST(substr(dig, length(dig) - j, 1) AS INTEGER) END)) % 10 = 0
    WHEN 'phone' THEN length(dig) BETWEEN 10 AND 15 ELSE true END),
hot AS MATERIALIZED (SELECT doc_id, text FROM t WHERE doc_id IN (SELECT doc_id FROM base)),
chars AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(1, length(text) + 1)) AS p FROM hot),
hidden AS (SELECT DISTINCT doc_id, p FROM base, unnest(range(s + 1, e + 1)) AS u(p)),
blank AS (SELECT c.doc_id, string_agg(CASE WHEN h.p IS NULL THEN c.c ELSE ' ' END, '' ORDER BY c.p) AS masked
          FROM chars c LEFT JOIN hidden h ON h.doc_id = c.doc_id AND h.p = c.p GROUP BY 1),
mask AS (SELECT hot.doc_id, text, masked FROM hot JOIN blank ON blank.doc_id = hot.doc_id),
ents AS (SELECT DISTINCT b.doc_id, m.text, unnest(list_concat([b.k || ':' || v], CASE kind
           WHEN 'email' THEN list_concat(['domain:' || split_part(v, '@', 2)], list_transform(list_filter(
                regexp_extract_all(split_part(v, '@', 1), '{_WORD}'), lambda w: length(w) >= 3), lambda w: 'local:' || w))
           WHEN 'ip' THEN ['net:' || array_to_string(string_split(v, '.')[1:3], '.')]
           WHEN 'card' THEN ['issuer:' || substr(dig, 1, 6)] ELSE ['block:' || substr(dig, 1, length(dig) - 4)] END)) AS entity
         FROM (SELECT doc_id, kind, k, {_LOWER.format('v')} AS v, regexp_replace(v, '[^0-9]', '', 'g') AS dig FROM base) b
         JOIN mask m ON m.doc_id = b.doc_id),
ent AS (SELECT entity, count(DISTINCT text) AS n_e FROM ents GROUP BY 1 HAVING count(DISTINCT text) >= {D.min_support}),
held AS (SELECT e.doc_id, e.text, e.entity, n_e FROM ents e JOIN ent USING (entity)),
mw AS (SELECT doc_id, text, regexp_extract_all({_LOWER.format('masked')}, '{_WORD}') AS f, regexp_split_to_array({_LOWER.format('masked')}, '{_WORD}') AS g
       FROM mask WHERE doc_id IN (SELECT doc_id FROM held)),
w AS (SELECT doc_id, text, f[i] AS term, {_AT.format(g='g', f='f')} AS s FROM mw, unnest(range(1, len(f) + 1)) AS u(i)
      WHERE length(f[i]) >= {D.min_chars}),
pairs AS (SELECT entity, term, count(DISTINCT h.text) AS n_et FROM held h JOIN (SELECT DISTINCT doc_id, term FROM w) USING (doc_id)
          GROUP BY 1, 2 HAVING count(DISTINCT h.text) >= {D.min_support}),
freq AS (SELECT term, count(DISTINCT text) AS n_t FROM (
           SELECT text, unnest(list_distinct(regexp_extract_all({_LOWER.format('text')}, '{_WORD}'))) AS term FROM t)
         WHERE term IN (SELECT term FROM pairs) GROUP BY 1),
tot AS (SELECT count(DISTINCT text) AS n FROM t),
dis AS (SELECT p.entity, p.term FROM pairs p JOIN ent e ON e.entity = p.entity JOIN freq f ON f.term = p.term, tot
        WHERE e.n_e < tot.n AND ln(p.n_et * tot.n / (e.n_e * f.n_t)) / ln(tot.n / e.n_e) >= {D.alpha}),
spans AS (SELECT doc_id, s, k, kind, e FROM base UNION ALL
          SELECT DISTINCT w.doc_id, w.s, 4, 'term', w.s + length(w.term) FROM w JOIN held h ON h.doc_id = w.doc_id
          JOIN dis d ON d.entity = h.entity AND d.term = w.term),
b AS (SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
             count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS x FROM base GROUP BY 1),
a AS (SELECT doc_id, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS x FROM spans GROUP BY 1)
SELECT t.doc_id, coalesce(b.n_email, 0) AS n_email, coalesce(b.n_ip, 0) AS n_ip, coalesce(b.n_card, 0) AS n_card,
       coalesce(b.n_phone, 0) AS n_phone, sha256(coalesce(b.x, '')) AS base_sha256, coalesce(a.x, '') AS spans
FROM t LEFT JOIN b ON b.doc_id = t.doc_id LEFT JOIN a ON a.doc_id = t.doc_id
"""
