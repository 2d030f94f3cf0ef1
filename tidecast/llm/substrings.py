"""Substring dedup by recompression: repeated passages of whole word windows.

Method. Every document is a string of word symbols. A round joins neighbours
into one symbol: runs of equal symbols, and pairs whose left symbol falls in the
left and whose right symbol in the right half of the alphabet (a bit of the
symbol's name drawn anew each round). A symbol's name is a hash of what it
consists of, so names are global: every task, document and run gives equal
strings equal interior symbols without exchanging a dictionary. With each symbol
goes its extent, the stretch of words that decided its limits; wherever the same
stretch occurs the same symbol occurs.

After ``ROUNDS`` rounds every window of ``n`` words takes as its anchor, among the
symbols whose extent lies in the window, the one of the smallest name (of the
highest level that has one; a single word at the worst), so equal windows have
equal anchors at equal places. Consecutive windows with one anchor form a run,
one row: its key (the anchor with its extent) and a 128-bit name of all its
words. Then

1. keys that stand in one document only are dropped; runs of equal name hold the
   same windows: all but those of the smallest doc_id are repeats, found by one
   minimum per name;
2. only where different runs share a key (the ends and edits of a repeated
   passage) are the windows of the smallest document of each run written out one
   by one and compared by their 128-bit names.

Plan. One row per about 20 words leaves the first pass; both minima are partial
aggregations, so a passage in a third of all documents reaches its reducer as
one row per task; names are joined back with unique keys on one side, which
Spark splits under skew. Documents are shuffled by id for the windows of step 2
(only documents that have any) and for the final pass.

Defined results. Null or blank text: no words. Documents of fewer than ``n`` words
keep all. Repeated rows, and rows of one doc_id, never repeat each other. A null
doc_id counts as larger than every other, and null ids do not repeat each
other. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .tables import arrow_map, small, stored

ROUNDS = 3
#: Words handled at once; longer documents go in overlapping segments.
SEGMENT = 60_000

_U = np.uint64


def _join(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ta.mix(a * _U(0xD6E8FEB86659FD93) + (b ^ _U((0x9E3779B97F4A7C15 * (2 * seed + 1)) & ta.MASK64)))


def doubling(words: np.ndarray, n: int, seed: int) -> list[np.ndarray]:
    """Names of all runs of 1, 2, 4, ... words up to ``n``."""
    out = [words]
    while 2 << (len(out) - 1) <= n and len(out[-1]) > 1 << (len(out) - 1):
        k = 1 << (len(out) - 1)
        out.append(_join(out[-1][:-k], out[-1][k:], seed))
    return out


def window_names(grams: list[np.ndarray], n: int, count: int, seed: int) -> np.ndarray:
    """Names of the ``count`` windows of ``n`` words, from the names of power-of-two runs."""
    at, name = 0, None
    for k in range(n.bit_length() - 1, -1, -1):
        if n >> k & 1:
            part = grams[k][at:at + count]
            name = part if name is None else _join(name, part, seed + 1)
            at += 1 << k
    return name


def recompress(words: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Per level (names, start, lo, hi) of the symbols of texts laid end to end.
    A symbol whose limits hang on a text's end gets an extent beyond that end."""
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.arange(len(words), dtype=np.int64)
    levels = [(words, at, at, at + 1)]
    for r in range(ROUNDS):
        names, start, lo, hi = levels[-1]
        text = begin[start]
        right = (ta.mix(names + _U(0x51ED27 + r)) & _U(1)).astype(bool)
        joins = (text[1:] == text[:-1]) & ((names[1:] == names[:-1]) | (~right[:-1] & right[1:]))
        first = np.flatnonzero(np.concatenate(([True], ~joins)))
        last = np.concatenate((first[1:], [len(names)])) - 1
        size = last - first + 1
        place = (np.arange(len(names)) - np.repeat(first, size)).astype(np.uint64)
        with np.errstate(over="ignore"):
            total = np.add.reduceat(ta.mix(names + place * _U(0xA0761D6478BD642F)), first)
            new = np.where(size > 1, ta.mix(total + size.astype(np.uint64)), names[first])
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(names) - 1)
        own = text[first]
        lo2 = np.where((first > 0) & (text[before] == own), lo[before], own - 1)
        hi2 = np.where((last + 1 < len(names)) & (text[after] == own), hi[after], end[start[first]] + 1)
        levels.append((new, start[first], lo2, hi2))
    return levels


def anchors(levels: list[tuple[np.ndarray, ...]], starts: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(level, symbol index, its start, lo, hi) of the anchor of every window."""
    m = len(starts)
    out = [np.full(m, -1, dtype=np.int64) for _ in range(5)]
    open_ = np.arange(m)
    for level in range(len(levels) - 1, -1, -1):
        names, start, lo, hi = levels[level]
        s = starts[open_]
        a, b = np.searchsorted(lo, s, "left"), np.searchsorted(hi, s + n, "right")
        has = a < b
        if has.any():
            rank = ta.mix(names ^ _U(0x2545F4914F6CDD1D))
            best = _range_min(rank, a[has], b[has])
            w = open_[has]
            out[0][w], out[1][w] = level, best
            out[2][w], out[3][w], out[4][w] = start[best], lo[best], hi[best]
        open_ = open_[~has]
        if not len(open_):
            break
    return tuple(out)


def _range_min(rank: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leftmost index of the smallest rank in each [a, b)."""
    k = np.frexp((b - a).astype(np.float64))[1] - 1
    table, best = np.arange(len(rank)), np.empty(len(a), dtype=np.int64)
    for level in range(int(k.max()) + 1):
        if level:
            half = 1 << (level - 1)
            x, y = table[:-half], table[half:]
            table = np.where(rank[x] <= rank[y], x, y)
        sel = k == level
        if sel.any():
            x, y = table[a[sel]], table[b[sel] - (1 << level)]
            best[sel] = np.where(rank[x] <= rank[y], x, y)
    return best


def window_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    sizes = np.maximum(np.diff(offsets) - n + 1, 0)
    return np.arange(sizes.sum()) + np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes)


def runs(words: np.ndarray, offsets: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """The runs of all texts: text, start (in the laid-out words), count, key, n1, n2."""
    starts = window_starts(offsets, n)
    if not len(starts):
        return {k: np.empty(0, dtype=np.int64) for k in ("text", "start", "count", "key", "n1", "n2")}
    level, symbol, at, lo, hi = anchors(recompress(words, offsets), starts, n)
    new = np.concatenate(([True], (level[1:] != level[:-1]) | (symbol[1:] != symbol[:-1]) | (np.diff(starts) != 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(starts)])) - 1
    s1, s2 = starts[first], starts[last]
    at, lo, hi = at[first], lo[first], hi[first]
    shape = ((at - s1) * 4096 + (s2 - s1)).astype(np.uint64)
    named, key = [], None
    for seed in (11, 23):
        grams = doubling(words, n, seed)
        name = window_names(grams, n, len(words) - n + 1, seed)
        named.append(_join(_join(name[s1], name[s2], seed + 2), shape, seed + 3))
        if key is None:
            size = hi - lo
            k = np.frexp(size.astype(np.float64))[1] - 1
            left, right = np.empty(len(size), dtype=np.uint64), np.empty(len(size), dtype=np.uint64)
            for j in np.unique(k):
                sel = k == j
                left[sel], right[sel] = grams[j][lo[sel]], grams[j][hi[sel] - (1 << j)]
            key = _join(_join(left, right, 5), (size * 4096 + (at - lo)).astype(np.uint64), 6)
    return {"text": np.searchsorted(offsets, s1, "right") - 1, "start": s1, "count": last - first + 1,
            "key": key.view(np.int64), "n1": named[0].view(np.int64), "n2": named[1].view(np.int64)}


_KEYS = "doc_id {id}, text_key bigint"
RUN_FIELDS = _KEYS + ", start bigint, count int, key bigint, n1 bigint, n2 bigint"


def _segments(words: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for a in range(0, max(1, len(words) - n + 1), SEGMENT):
        yield a, words[a:a + SEGMENT + n - 1]


def _run_batches(n: int):
    def rows_of(batch: pa.RecordBatch, group: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        offsets = np.concatenate(([0], np.cumsum([len(w) for _, _, w in group]))).astype(np.int64)
        r = runs(np.concatenate([w for _, _, w in group]), offsets, n)
        row = np.array([i for i, _, _ in group], dtype=np.int64)[r["text"]]
        base = np.array([a for _, a, _ in group], dtype=np.int64)
        start = r["start"] - offsets[r["text"]] + base[r["text"]]
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.names.index(c)).take(take) for c in ("doc_id", "text_key")]
            + [pa.array(start), pa.array(r["count"].astype(np.int32))] + [pa.array(r[c]) for c in ("key", "n1", "n2")],
            names=["doc_id", "text_key", "start", "count", "key", "n1", "n2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, size = [], 0
            for texts in ta.groups(enumerate(ta.texts_of(batch.column(batch.schema.names.index("text")))), 2 * ta.CHUNK):
                words, offsets = ta.many_word_hashes([t for _, t in texts])
                for (i, _), a, b in zip(texts, offsets[:-1], offsets[1:]):
                    if b - a < n:
                        continue
                    for base, part in _segments(words[a:b], n):
                        group.append((i, base, part))
                        size += len(part)
                        if size >= SEGMENT:
                            yield rows_of(batch, group)
                            group, size = [], 0
            if group:
                yield rows_of(batch, group)
    return run


def _window_batches(n: int):
    """The windows of the listed runs of a document: (doc_id, text_key, start, g1, g2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for i, text in enumerate(ta.texts_of(col["text"])):
                words = ta.word_hashes(text)
                wanted = sorted((x["start"], x["count"]) for x in col["runs"][i].as_py())
                starts = np.unique(np.concatenate([np.arange(s, s + c) for s, c in wanted]))
                g = [window_names(doubling(words, n, seed), n, len(words) - n + 1, seed)[starts].view(np.int64)
                     for seed in (11, 23)]
                take = pa.array(np.full(len(starts), i))
                yield pa.RecordBatch.from_arrays(
                    [col["doc_id"].take(take), col["text_key"].take(take), pa.array(starts), pa.array(g[0]), pa.array(g[1])],
                    names=["doc_id", "text_key", "start", "g1", "g2"])
    return run


def _kept_batches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            facts = []
            for i, text in enumerate(ta.texts_of(col["text"])):
                words = (text or b"").split()
                gone = col["gone"][i].as_py() or []
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for x in gone:
                    edge[x["a"]] += 1
                    edge[x["b"]] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                left = words if stay.all() else [w for w, s in zip(words, stay) if s]
                facts.append((len(words), len(words) - len(left), b" ".join(left)))
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"], pa.array([f[0] for f in facts], pa.int64()), pa.array([f[1] for f in facts], pa.int64()),
                 pa.array([hashlib.sha256(f[2]).hexdigest() for f in facts], pa.string()),
                 pa.array([f[2].decode("utf-8", "replace") for f in facts], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _ends(doc: str) -> list:
    """Smallest and largest document of a group, and whether it has one without an id."""
    return [F.min(doc).alias("lo"), F.max(doc).alias("hi"), F.max(F.col(doc).isNull()).alias("nul")]


#: Two documents at least, of which one is smaller.
_TWO = "lo < hi OR (nul AND lo IS NOT NULL)"


def repeated(docs: DataFrame, n: int = 50) -> DataFrame:
    """(doc_id, text_key, a, b): stretches of words covered by repeated windows."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(arrow_map(_keyed(docs), _run_batches(n), RUN_FIELDS.format(id=kind)), "substr_runs")
    # only keys that stand in two documents matter from here on
    shared = stored(rows.groupBy("key").agg(*_ends("doc_id")).filter(_TWO).select("key"), "substr_keys")
    rows = stored(rows.join(shared, "key", "left_semi"), "substr_shared")
    names = stored(rows.groupBy("key", "n1", "n2").agg(F.min("doc_id").alias("first_doc")), "substr_names")
    spread = names.groupBy("key").agg(*_ends("first_doc")).filter(_TWO).select("key", F.lit(True).alias("varied"))
    names = stored(names.join(spread, "key", "left"), "substr_named")
    marked = stored(rows.join(names, ["key", "n1", "n2"]).drop("key", "n1", "n2"), "substr_marked")
    # whole runs that stand in a smaller document too
    whole = marked.filter("doc_id > first_doc OR (doc_id IS NULL AND first_doc IS NOT NULL)") \
        .select("doc_id", "text_key", F.col("start").alias("a"), (F.col("start") + F.col("count") + (n - 1)).alias("b"))
    # the others of a key with different runs: window by window
    open_ = marked.filter(F.col("varied") & F.col("doc_id").eqNullSafe(F.col("first_doc")))
    per_doc = stored(open_.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__k")).agg(
        F.collect_set(F.struct("start", "count")).alias("runs")), "substr_open")
    d = _keyed(docs)
    few = small(per_doc.select(F.col("__k").alias("text_key")).distinct())  # most documents have none: drop them first
    d = d.join(few, "text_key", "left_semi")
    texts = d.join(per_doc, d.doc_id.eqNullSafe(F.col("__id")) & (d.text_key == F.col("__k"))) \
        .select("doc_id", "text_key", "text", "runs")
    wins = stored(arrow_map(texts, _window_batches(n), f"{_KEYS.format(id=kind)}, start bigint, g1 bigint, g2 bigint"),
                  "substr_windows")
    firsts = stored(wins.groupBy("g1", "g2").agg(*_ends("doc_id")).filter(_TWO).select("g1", "g2", F.col("lo").alias("first_doc")),
                    "substr_firsts")
    single = wins.join(firsts, ["g1", "g2"]).filter("doc_id > first_doc OR doc_id IS NULL") \
        .select("doc_id", "text_key", F.col("start").alias("a"), (F.col("start") + n).alias("b"))
    return whole.unionByName(single)


def deduplicated(docs: DataFrame, n: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    gone = stored(repeated(docs, n).groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__k")).agg(
        F.collect_list(F.struct("a", "b")).alias("gone")), "substr_gone")
    d = _keyed(docs)
    rows = d.join(gone, d.doc_id.eqNullSafe(F.col("__id")) & (d.text_key == F.col("__k")), "left") \
        .select("doc_id", "text", "gone")
    return arrow_map(rows, _kept_batches(n), f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
