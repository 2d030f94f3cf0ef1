"""Quality rules: cross-document line frequency per host.

Method. Every line is normalised (ASCII lower case, words joined by one space)
and hashed. Per host (``source``) the number of distinct documents that carry a
line is counted; copies of one text count as one document, so a page that was
merely fetched often is no boilerplate. A line above the host's limit is
removed from every document of the host except the first one that carries it
(smallest doc_id), and a document that loses so many words that too few remain
is rejected (depleted).

Plan. One Arrow pass computes the base counts and the line hashes and is stored;
the line count is a two-step aggregation (partial on the map side, so a line in
a third of all documents reaches its reducer as one row per task); the lines
above the limit are joined back on (host, line), a plain equi-join whose right
side has unique keys, which Spark splits when a line is hot.

Defined results. Null or blank text: all counts 0, ``base_failed`` true,
``kept`` false. Null source: one host of its own. Repeated rows: every input row
gives one output row; equal texts count once per host. Rows of equal doc_id
are judged separately. A null doc_id sorts first as carrier of a line. Empty
table: no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .tables import arrow_map, free, stored


@dataclass(frozen=True)
class Rules:
    min_words: int = 10          # base rule
    repeat_share: int = 20       # base rule, per cent of the words in repeated windows
    window: int = 5
    line_docs: int = 20          # a line in at most so many distinct documents of a host always stays
    line_share: float = 0.02     # ... or in at most this share of the host's distinct documents
    left_share: float = 0.2      # a document must keep this share of its words and min_words


SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

BASE_FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
               "n_repeat_words bigint, lines array<struct<h:bigint,w:int,i:int>>")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def repeat_words(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Per text: words inside some n-word window that the text has twice or more."""
    grams = ta.ngram_hashes(words, n)
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    if not len(grams):
        return counts
    text = np.repeat(np.arange(len(counts), dtype=np.int64), np.diff(offsets))
    start = np.flatnonzero(text[:len(grams)] == text[n - 1:])
    if not len(start):
        return counts
    with np.errstate(over="ignore"):
        key = ta.mix(grams[start] + ta.mix(text[start].astype(np.uint64) + np.uint64(99)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[start[twice]] += 1
    edge[start[twice] + n] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(text[covered], minlength=len(counts)).astype(np.int64)


def line_facts(text: bytes) -> tuple[int, list[dict]]:
    """(lines equal to an earlier line; hash, word count and place of each line with a word)."""
    seen, dup, out = set(), 0, []
    for i, line in enumerate(text.split(b"\n")):
        words = line.lower().split()
        if not words:
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        out.append({"h": _signed(xxhash.xxh3_64_intdigest(b" ".join(words))), "w": len(words), "i": i})
    return dup, out


def _base_batches(window: int, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ta.texts_of(batch.column(batch.schema.names.index("text")))
            for group in ta.groups(enumerate(texts)):
                rows = [t or b"" for _, t in group]
                words, offsets = ta.many_word_hashes(rows)
                buf = np.frombuffer(b"\n".join(rows) + b"\n", dtype=np.uint8)
                at = np.cumsum([0] + [len(r) + 1 for r in rows[:-1]])
                points = ((buf & 0xC0) != 0x80) & ~ta._SPACE[buf]
                facts = [line_facts(r) for r in rows]
                lo, n = group[0][0], len(rows)
                cols = [batch.column(batch.schema.names.index(k)).slice(lo, n) for k in keys]
                cols += [pa.array(np.diff(offsets)),
                         pa.array(np.add.reduceat(points, at, dtype=np.int64)),
                         pa.array(np.add.reduceat(SYMBOLS[buf], at, dtype=np.int64)),
                         pa.array([f[0] for f in facts], pa.int64()),
                         pa.array(repeat_words(words, offsets, window)),
                         pa.array([f[1] for f in facts], pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int32()), ("i", pa.int32())])))]
                names = keys + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def base_counts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One stored row per document: row_id, doc_id, source, the base counts, the line hashes."""
    keys = ["doc_id", "source", "text_hash"]
    src = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), "text")
    kinds = ", ".join(f"{k} {src.schema[k].dataType.simpleString()}" for k in keys)
    base = arrow_map(src, _base_batches(rules.window, keys), f"{kinds}, {BASE_FIELDS}")
    return stored(base.withColumn("row_id", F.monotonically_increasing_id()), "quality_base")


def frequent_lines(base: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(source, h, n_docs, first_doc) of the lines above their host's limit."""
    lines = base.select("source", "text_hash", "doc_id", F.explode(F.array_distinct("lines.h")).alias("h"))
    freq = (lines.groupBy("source", "h")
            .agg(F.count_distinct("text_hash").alias("n_docs"), F.min("doc_id").alias("first_doc"),
                 F.max(F.col("doc_id").isNull()).alias("null_first"))
            .filter(F.col("n_docs") > rules.line_docs))
    hosts = base.groupBy(F.col("source").alias("host")).agg(F.count_distinct("text_hash").alias("host_docs"))
    return (freq.join(hosts, F.col("source").eqNullSafe(F.col("host")))
            .filter(F.col("n_docs") > F.col("host_docs") * F.lit(rules.line_share))
            .select(F.col("source").alias("host"), "h", "n_docs",
                    F.when(~F.col("null_first"), F.col("first_doc")).alias("first_doc")))


def removed_lines(base: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """row_id, removed words and the places (0-based, of the \n-split lines) of the removed lines."""
    over = frequent_lines(base, rules)
    lines = base.select("row_id", "source", "doc_id", F.explode("lines").alias("line"))
    hit = (lines.join(over, lines.source.eqNullSafe(over.host) & (lines["line.h"] == over.h))
           .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc"))))
    return hit.groupBy("row_id").agg(F.sum("line.w").cast("bigint").alias("n_removed_words"),
                                     F.collect_list("line.i").alias("removed_at"))


def base_failed(rules: Rules = Rules()) -> Column:
    return (F.col("n_words") < rules.min_words) | \
        (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_share)


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The base counts of every document with n_removed_words, removed_at, base_failed, depleted and kept."""
    base = base_counts(docs, rules)
    gone = removed_lines(base, rules).withColumnRenamed("row_id", "gone_row")
    out = base.drop("lines").join(gone, F.col("row_id") == F.col("gone_row"), "left").drop("gone_row") \
        .fillna(0, ["n_removed_words"])
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < rules.min_words) | (left < F.col("n_words") * F.lit(rules.left_share)))
    return out.withColumn("base_failed", base_failed(rules)).withColumn("depleted", depleted) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))


def cleaned(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept documents, all their columns, with the frequent lines taken out of the text.

    Texts without a removed line are returned unchanged. Verdicts are joined on
    (doc_id, source, text hash), so repeated rows stay repeated and rows of one
    doc_id are judged apart.
    """
    i, h, t, g = (free(c, docs) for c in ("__id", "__s", "__t", "__gone"))
    verdict = judged(docs, rules).filter("kept").select(
        F.col("doc_id").alias(i), F.col("source").alias(h), F.col("text_hash").alias(t),
        F.col("removed_at").alias(g)).dropDuplicates([i, h, t])
    rows = docs.join(verdict, docs.doc_id.eqNullSafe(F.col(i)) & docs.source.eqNullSafe(F.col(h))
                     & (F.xxhash64(docs.text) == F.col(t)))
    stay = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, k: ~F.array_contains(g, k)), "\n")
    return rows.withColumn("text", F.when(F.col(g).isNull(), F.col("text")).otherwise(stay)).select(docs.columns)
