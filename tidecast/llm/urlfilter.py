"""URL filters: a temporal list join.

Method. A filter list is a stream of dated entries (list, kind, pattern, action
add or remove). ``validity`` turns it into intervals: an ``add`` opens one, the
next entry of the same (list, kind, pattern) that removes it closes it; an
``add`` while open and a ``remove`` while closed change nothing. Every capture
has a fetch time and is evaluated by an as-of join against the entries active at
that time: valid_from <= fetched < valid_to.

Plan. DataFrame functions only. A URL is turned into the few keys it can match:
its host, the parent domains (``domain`` patterns match a host and what is below
it) and host plus path prefixes. Intervals of one key are gathered into one row
(their number is the number of list changes of that key, not of captures), so
the join is an equi-join with unique keys on the list side: a host with a third
of all captures is split by Spark's skew handling, and no pair of capture and
entry outside its key is ever made. Page contents are never moved.

Defined results. Null or host-less URL: no keys, not blocked. Null fetch time:
no entry is active. Entries with a null date, pattern, list or unknown action
are ignored. Ties: of entries of the same instant the remove counts last, so a
key added and removed at one instant is not listed. Repeated entries change
nothing; repeated captures give a row each. Empty tables: no rows, or nothing
blocked. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import fits_broadcast, stored

FOREVER = "9999-12-31"
#: Parts over which the captures of one list key are dealt where the lists do not fit a broadcast.
SALTS = 16


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot ('' if there is none)."""
    auth = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(F.lower(auth), r"^.*@", ""), r"(?::[0-9]*)?$|\.(?::[0-9]*)?$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def validity(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) from dated add / remove entries.

    One window per (list, kind, pattern): its rows are the changes of one list
    entry, spread over as many keys as the lists have patterns.
    """
    known = entries.filter(F.col("action").isin("add", "remove") & F.col("at").isNotNull()
                           & F.col("pattern").isNotNull() & F.col("list").isNotNull() & F.col("kind").isNotNull())
    # one state per instant: a remove outweighs an add of the same instant
    state = known.groupBy("list", "kind", "pattern", "at").agg(F.max(F.col("action") == "remove").alias("off"))
    key = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    change = state.withColumn("was_off", F.coalesce(F.lag("off").over(key), F.lit(True))).filter(F.col("off") != F.col("was_off"))
    ends = F.coalesce(F.lead("at").over(key), F.to_timestamp_ntz(F.lit(FOREVER + " 00:00:00")))
    return (change.withColumn("valid_to", ends).filter(~F.col("off"))
            .select("list", "kind", "pattern", F.col("at").alias("valid_from"), "valid_to"))


def capture_keys(url: Column) -> Column:
    """The (kind, pattern) keys a URL can match."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, n), ".").alias("pattern")))
    steps = F.split(path_of(url), "/")
    paths = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))), lambda i: F.struct(
        F.lit("path").alias("kind"), F.concat(host_of(url), F.array_join(F.slice(steps, 1, i), "/")).alias("pattern")))
    host = F.array(F.struct(F.lit("host").alias("kind"), host_of(url).alias("pattern")))
    keys = F.concat(host, domains, F.when(path_of(url) != "", paths).otherwise(F.array().cast("array<struct<kind:string,pattern:string>>")))
    return F.when(F.coalesce(host_of(url), F.lit("")) != "", F.array_distinct(keys))


def active(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, fetched, list, kind, pattern, valid_from): the entries active at each capture's fetch time.

    The intervals of a (kind, pattern) are one row. Lists that fit are broadcast: a host with a third of all
    captures stays spread as it was read. Longer ones meet the keys that are on some list by a shuffle in which
    the captures of a key are dealt over ``SALTS`` parts.
    """
    spans = stored(validity(entries).groupBy(F.col("kind").alias("k"), F.col("pattern").alias("p")).agg(
        F.collect_list(F.struct("list", "valid_from", "valid_to")).alias("spans")), "urlfilter_spans")
    keys = captures.select(F.col(key).alias("id"), F.col("url").alias("u"), F.col("fetched").alias("at"), F.explode(capture_keys(F.col("url"))).alias("q"))
    on = (F.col("q.kind") == F.col("k")) & (F.col("q.pattern") == F.col("p"))
    if fits_broadcast(spans):
        j = keys.join(F.broadcast(spans), on)
    else:
        part = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        j = keys.withColumn("part", part).join(spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
                                               on & (F.col("part") == F.col("salt")))
    now = F.filter("spans", lambda s: (s["valid_from"] <= F.col("at")) & (F.col("at") < s["valid_to"]))
    return j.select("id", "u", "at", "k", "p", F.explode(now).alias("s")).select(
        F.col("id").alias(key), F.col("u").alias("url"), F.col("at").alias("fetched"), "s.list", F.col("k").alias("kind"),
        F.col("p").alias("pattern"), "s.valid_from")


def evaluated(captures: DataFrame, entries: DataFrame, allow: str = "allow", key: str = "page_id") -> DataFrame:
    """One row per capture: its host, the lists active for it (sorted), the latest
    entry date, and ``blocked``: on some list and not on the allow list."""
    captures = captures.select(key, "url", "fetched")
    hits = active(captures, entries, key)
    per = hits.groupBy(F.col(key).alias("__k"), F.col("url").alias("__u"), F.col("fetched").alias("__f")).agg(
        F.array_sort(F.collect_set("list")).alias("lists"), F.max("valid_from").alias("since"),
        F.count_distinct("list", "kind", "pattern").alias("n_entries"))
    j = captures.join(per, captures[key].eqNullSafe(F.col("__k")) & captures.url.eqNullSafe(F.col("__u"))
                      & captures.fetched.eqNullSafe(F.col("__f")), "left")
    lists = F.coalesce("lists", F.array().cast("array<string>"))
    return j.select(captures[key], host_of(captures.url).alias("host"), captures.fetched,
                    lists.alias("lists"), "since", F.coalesce("n_entries", F.lit(0)).cast("bigint").alias("n_entries"),
                    ((F.size(lists) > 0) & ~F.array_contains(lists, allow)).alias("blocked"))
