"""Benchmark decontamination: a distributed positional inverted index.

Method. Benchmark texts give windows of ``n`` consecutive words (an item with
fewer words is one window). The corpus frequency of every benchmark word is
counted over all documents; for each window the two rarest of its words are its
list heads. The positions of exactly those words are stored as postings
(term, doc_id, pos). The list of the rarest word, moved back by the word's place
in the window, gives candidate starts; they are intersected with the list of the
second-rarest word moved by its own place (``slop`` > 0 keeps starts that
disagree by at most that many words). What survives is compared word by word with
the document, which makes phrase and proximity matches exact. A proximity match
has all words of the window, each at a position of its own, with
max(p_i - i) - min(p_i - i) <= slop over the positions p_i of the words i: up to
``slop`` words in between, or a change of order that moves words no further apart.

Plan. DataFrame functions only. The benchmark side is broadcast only after its
rows have been counted (``tables.small``); beyond that the same joins are
shuffle joins. Map-side combine reduces the word counts to one row per word and
task. A word that is in every document is a list head only of windows that have
no rarer word. Documents are shuffled once, for the final comparison, by doc_id.

Defined results. Null or wordless text: no words, no hits. Null or wordless
items: no window, never counted. Items of equal text count as one each. Null
doc_id or repeated doc_ids: every input row is judged by its own text. Empty
benchmark: nothing is hit; empty corpus: no rows. Other columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free, small, stored

#: Separators: every ASCII character that is no digit and no lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Index:
    """The stored parts of one run: windows (wid, item_ids, words) and candidate starts per
    document; docs are the documents themselves, as given."""
    windows: DataFrame
    heads: DataFrame
    postings: DataFrame
    docs: DataFrame


def words(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lower, SEPARATORS), ""), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """(wid, words, item_ids): the distinct windows and the items that have them."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1)))
    win = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, n))).alias("words"))
    return (win.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
            .withColumn("wid", F.sha2(F.array_join("words", " "), 256)))


def list_heads(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(wid, first, first_at, second, second_at): the two rarest words of each
    window in the corpus and their places; second is null in a window of one
    distinct word. A window with a word that no document has is left out."""
    places = windows.select("wid", F.posexplode("words").alias("at", "term"))
    vocabulary = places.select("term").distinct()
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    counts = tokens.join(small(vocabulary), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = (places.groupBy("wid", "term").agg(F.min("at").alias("at"))
              .join(stored(counts, "decontam_counts"), "term", "left")
              .groupBy("wid").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "at"))).alias("r")))
    return ranked.filter(F.col("r")[0]["n"] > 0).select(
        "wid", F.col("r")[0]["term"].alias("first"), F.col("r")[0]["at"].alias("first_at"),
        F.get("r", F.lit(1))["term"].alias("second"), F.get("r", F.lit(1))["at"].alias("second_at"))


def postings(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """(term, doc_id, text_key, pos) of every occurrence of a list head in the corpus."""
    terms = heads.select(F.explode(F.array("first", "second")).alias("term")).filter("term IS NOT NULL").distinct()
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return tokens.join(small(terms), "term", "left_semi").select("term", "doc_id", "text_key", "pos")


def build(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> Index:
    windows = stored(item_windows(benchmark, n), "decontam_windows")
    heads = stored(list_heads(windows, docs), "decontam_heads")
    return Index(windows, heads, stored(postings(docs, heads), "decontam_postings"), docs)


def candidates(index: Index, slop: int = 0) -> DataFrame:
    """(wid, doc_id, text_key, start): the offset-adjusted lists of the two rarest words of
    each window, intersected; starts differ by at most ``slop`` words."""
    p = index.postings
    first = (p.join(small(index.heads), F.col("term") == F.col("first"))
             .select("wid", "doc_id", "text_key", (F.col("pos") - F.col("first_at")).alias("start"), "second",
                     (F.col("pos") - F.col("first_at") + F.col("second_at")).alias("want")))
    alone = first.filter("second IS NULL").select("wid", "doc_id", "text_key", "start")
    step = slop + 1
    lists = p.select(F.col("term").alias("t2"), F.col("doc_id").alias("d2"), F.col("text_key").alias("k2"), F.col("pos").alias("p2"),
                     F.expr(f"p2 div {step}").alias("cell"))
    near = first.filter("second IS NOT NULL")
    cells = F.array(F.expr(f"want div {step}")) if slop == 0 else \
        F.array(*[F.expr(f"floor(want / {step})").cast("bigint") + k for k in (-1, 0, 1)])
    near = near.withColumn("near", F.explode(cells))
    both = near.join(lists, (near.second == lists.t2) & (near.text_key == lists.k2) & near.doc_id.eqNullSafe(lists.d2)
                     & (near.near == lists.cell) & (F.abs(near.want - lists.p2) <= slop))
    out = alone.unionByName(both.select("wid", "doc_id", "text_key", "start"))
    return out if slop == 0 else out.distinct()


def _met(docs: DataFrame, index: Index, slop: int, how: str) -> DataFrame:
    """doc_id, text_key, w (the words) and cand, the candidate windows, of every document."""
    found = candidates(index, slop).join(small(index.windows), "wid")
    per_doc = found.groupBy(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_text")).agg(
        F.collect_set(F.struct(F.col("start").cast("int").alias("start"), "words", "item_ids")).alias("cand"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = rows.join(per_doc, (F.col("text_key") == F.col("hit_text")) & F.col("doc_id").eqNullSafe(F.col("hit_doc")), how)
    return rows.select("doc_id", "text_key", words(F.col("text")).alias("w"), "cand")


def _same(c: Column) -> Column:
    return (c["start"] >= 0) & (F.slice("w", F.greatest(c["start"], F.lit(0)) + 1, F.size(c["words"])) == c["words"])


def phrase_matches(docs: DataFrame, index: Index, slop: int = 0) -> DataFrame:
    """Per document: doc_id, text_key, w (its words), hits, the verified occurrences (start, len, item_ids) in
    order of start, and near, the item_ids of windows matched within ``slop`` words (with repetitions)."""
    rows = _met(docs, index, slop, "left")
    hits = F.array_sort(F.transform(F.filter("cand", _same), lambda c: F.struct(
        c["start"].alias("start"), F.size(c["words"]).alias("len"), c["item_ids"].alias("item_ids"))))
    met = F.filter("cand", lambda c: _same(c) | near_window(F.col("w"), c["words"], c["start"], slop)) if slop else F.filter("cand", _same)
    near = F.flatten(F.transform(met, lambda c: c["item_ids"]))
    return rows.select("doc_id", "text_key", "w", F.when(F.col("cand").isNotNull(), hits).alias("hits"),
                       F.when(F.col("cand").isNotNull(), near).alias("near"))


def near_window(w: Column, words: Column, start: Column, slop: int) -> Column:
    """All of ``words`` stand in ``w``, each at a position of its own between its place and ``slop``
    after it, for a first place of ``start`` - slop to ``start``. Equal words take the first free
    position in order, which finds positions for all of them if there are any."""
    none = F.array().cast("array<int>")

    def placed(low):
        def step(used, i):
            span = F.sequence(low + i, low + i + slop)
            free = F.filter(span, lambda p: (p >= 0) & (F.get(w, p) == F.get(words, i)) & ~F.array_contains(used, p))
            return F.when(F.size(free) > 0, F.concat(used, F.slice(free, 1, 1))).otherwise(F.lit(None).cast("array<int>"))
        return F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), none, step).isNotNull()

    return F.exists(F.sequence(start - slop, start), placed)


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """(doc_id, item_id): items of which a document holds all words of some window, give or take ``slop`` words."""
    m = phrase_matches(index.docs, index, slop)
    return m.select("doc_id", F.explode(F.array_distinct("near")).alias("item_id")).distinct()


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted item_ids as strings), near_items (those with a window matched
    within ``slop`` words, exact ones included), contaminated."""
    m = phrase_matches(docs, build(docs, benchmark, n), slop)
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def cover(acc, h):
        end = h["start"] + h["len"]
        new = F.greatest(end - F.greatest(acc["upto"], h["start"]), F.lit(0))
        return F.struct(F.greatest(acc["upto"], end).alias("upto"), (acc["n"] + new).alias("n"))

    n_hit = F.coalesce(F.aggregate("hits", zero, cover)["n"], F.lit(0)).cast("bigint")

    def named(ids):
        return F.coalesce(F.array_sort(F.array_distinct(F.transform(ids, lambda i: i.cast("string")))), F.array().cast("array<string>"))
    return (m.select("doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
                     named(F.flatten("hits.item_ids")).alias("items"), named(F.col("near")).alias("near_items"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The documents (all columns) without those that hold a benchmark window."""
    i, k = free("__id", docs), free("__k", docs)
    bad = report(docs, benchmark, n).filter("contaminated") \
        .select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct()
    bad = small(stored(bad, "decontam_bad"))
    return docs.join(bad, docs.doc_id.eqNullSafe(F.col(i)) & (F.xxhash64(docs.text) == F.col(k)), "left_anti")
