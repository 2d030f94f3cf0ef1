"""op10: URL filters as a temporal list join.

The tables hold neither fetch times nor lists, so both are derived from
``pages``: a page is fetched on a day of 2024 given by a digest of its URL; every
host of the table yields six dated entries (three add / remove pairs whose list,
kind and days come from a digest of the host). Both grow with the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import urlfilter

LISTS = ["ads", "malware", "allow"]
KINDS = ["host", "domain", "path"]


def digest(c):
    """A number of 28 bits from the MD5 of a text (same in SQL)."""
    return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("bigint")


def day(c):
    return F.timestamp_add("DAY", (digest(c) % 366).cast("int"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))


def captures(pages):
    return pages.select("page_id", "url", day(F.col("url")).alias("fetched"))


def entries(pages):
    """(list, kind, pattern, action, at): six dated entries per host."""
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    e = hosts.select("host", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j"))
    pair = digest(F.concat_ws("#", "host", F.floor(F.col("j") / 2).cast("string")))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.floor(pair / 3) % 3 + 1).cast("int"))
    parent = F.regexp_replace("host", r"^[^.]+\.(?=[^.]+\.)", "")
    return e.select(
        F.element_at(F.array(*[F.lit(x) for x in LISTS]), (pair % 3 + 1).cast("int")).alias("list"), kind.alias("kind"),
        F.when(kind == "domain", parent).when(kind == "path", F.concat("host", F.lit("/en"))).otherwise(F.col("host")).alias("pattern"),
        F.when(F.col("j") % 2 == 0, "add").otherwise("remove").alias("action"),
        day(F.concat_ws("@", "host", F.col("j").cast("string"))).alias("at"))


def op10_url_filters(spark, sf_dir):
    """Every capture with the lists active for it at its fetch time."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urlfilter.evaluated(captures(pages), entries(pages)).select(
        "page_id", "host", "fetched", F.array_join("lists", ",").alias("lists"), "since", "n_entries", "blocked")


_DIG = "CAST('0x' || substr(md5({}), 1, 7) AS BIGINT)"
_DAY = "(TIMESTAMP '2024-01-01' + to_days(CAST(" + _DIG + " % 366 AS INTEGER)))"
_HOST = ("regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), "
         "'(:[0-9]*)?$|\\.(:[0-9]*)?$', '')")

SQL = f"""
WITH cap AS (SELECT page_id, url, {_HOST} AS host, {_DAY.format('url')} AS fetched,
                    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
hosts AS (SELECT DISTINCT host FROM cap WHERE host <> ''),
e0 AS (SELECT host, j, {_DIG.format("host || '#' || CAST(j // 2 AS VARCHAR)")} AS pair FROM hosts, range(0, 6) AS r(j)),
e AS (SELECT (['ads', 'malware', 'allow'])[pair % 3 + 1] AS lst, (['host', 'domain', 'path'])[(pair // 3) % 3 + 1] AS kind,
             CASE (pair // 3) % 3 WHEN 1 THEN CASE WHEN len(string_split(host, '.')) > 2
                  THEN array_to_string(string_split(host, '.')[2:], '.') ELSE host END
                  WHEN 2 THEN host || '/en' ELSE host END AS pattern,
             j % 2 = 1 AS closes, {_DAY.format("host || '@' || CAST(j AS VARCHAR)")} AS t FROM e0),
st AS (SELECT lst, kind, pattern, t, bool_or(closes) AS closes FROM e GROUP BY 1, 2, 3, 4),
ch AS (SELECT *, coalesce(lag(closes) OVER k, true) AS was FROM st WINDOW k AS (PARTITION BY lst, kind, pattern ORDER BY t)),
iv AS (SELECT lst, kind, pattern, t AS valid_from, closes,
              coalesce(lead(t) OVER (PARTITION BY lst, kind, pattern ORDER BY t), TIMESTAMP '9999-12-31') AS valid_to
       FROM ch WHERE closes <> was),
hit AS (SELECT c.page_id, i.lst, i.kind, i.pattern, i.valid_from FROM cap c JOIN iv i
        ON NOT i.closes AND c.host <> '' AND i.valid_from <= c.fetched AND c.fetched < i.valid_to
        AND ((i.kind = 'host' AND i.pattern = c.host)
          OR (i.kind = 'domain' AND (c.host = i.pattern OR ends_with(c.host, '.' || i.pattern)))
          OR (i.kind = 'path' AND (c.host || c.path = i.pattern OR starts_with(c.host || c.path, i.pattern || '/')))))
SELECT c.page_id, c.host, c.fetched, coalesce(array_to_string(list_sort(list(DISTINCT h.lst) FILTER (h.lst IS NOT NULL)), ','), '') AS lists,
       max(h.valid_from) AS since, count(DISTINCT (h.lst, h.kind, h.pattern)) FILTER (h.lst IS NOT NULL) AS n_entries,
       count(h.lst) > 0 AND count(*) FILTER (h.lst = 'allow') = 0 AS blocked
FROM cap c LEFT JOIN hit h ON h.page_id = c.page_id GROUP BY 1, 2, 3
"""
