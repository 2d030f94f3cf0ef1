"""Near-duplicate groups by circulant MinHash.

Method. A document is the set of its distinct word shingles. Shingles are placed
in a universe of ``UNIVERSE`` positions; one permutation (sigma) shuffles the
positions, a second one (pi), shifted circularly by k, gives coordinate k of the
signature: h_k = min over the set of pi[(sigma(x) + k) mod UNIVERSE]. All
coordinates of a shingle are one contiguous slice of pi. Bands of ``rows``
coordinates are hashed; documents that agree in a band are candidates, and a
candidate pair is linked only if the Jaccard similarity of the full shingle
sets reaches the threshold. Links give groups; a group's smallest doc_id stays.

Plan. Documents of one and the same shingle set are one node from the start, so a
group of exact copies costs one row. Within a band bucket no pairs are made:
every node is compared with the bucket's centre only (the node that shares most
buckets with others; another draw in later rounds), at most ``CENTRES`` per node
and round, preferring centres met in many bands. Linked nodes then share a
component, and buckets that lie within one component are done. What is still
mixed is settled exactly in a last round: a prefix join over the shingles in order of their rarity
(``remaining_pairs``) gives all pairs of different components that can reach the threshold, without
the buckets, and only those are compared. Texts of candidates are
stored once and joined to the pairs by key; links and components never leave
the executors.

A pair at the threshold escapes all bands with probability (1 - t^rows)^bands:
4e-7 for 0.85 (25 bands of 5 rows), 5e-8 for 0.8 (32 bands of 4 rows).

Defined results. Null or wordless text: empty set, linked with nothing, kept. With
fewer words than a shingle the whole sequence is the one shingle. Every input
row gives one row; rows of equal sets are in one group whatever their ids;
repeated rows of a group's smallest id are all marked kept. Null doc_id: never
the smallest, unless a group has no other id. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .tables import arrow_map, free, stored

UNIVERSE = 1 << 20
CENTRES = 3
#: Rounds against bucket centres before the last round; one finds nearly all links.
ROUNDS = 1
RARE = 8
#: So many of a node's first shingles are compared to make a pair once.
HEAD = 16
SEED = 20


@dataclass(frozen=True)
class Similar:
    shingle: int = 5
    percent: int = 80       # 100 * |A and B| >= percent * |A or B|

    @property
    def rows(self) -> int:
        return 5 if self.percent >= 85 else 4

    @property
    def bands(self) -> int:
        return 25 if self.percent >= 85 else 32


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a word sequence."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    if len(words) < n:
        return ta.mix(ta.ngram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(ta.ngram_hashes(words, n))


class Circulant:
    """The two permutations and the signatures they give."""

    def __init__(self, coordinates: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.n = coordinates
        self.sigma = rng.permutation(UNIVERSE).astype(np.int32)
        pi = rng.permutation(UNIVERSE).astype(np.int32)
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate((pi, pi[:coordinates])), coordinates)

    def signature(self, items: np.ndarray) -> np.ndarray:
        at = self.sigma[(items >> np.uint64(44)).astype(np.int64)]
        out = np.full(self.n, UNIVERSE, dtype=np.int32)
        for i in range(0, len(at), 2048):
            np.minimum(out, self.slices[at[i:i + 2048]].min(axis=0), out=out)
        return out


_CIRCULANT: dict[int, Circulant] = {}


def _band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = signature.reshape(bands, rows).astype(np.uint64)
    acc = ta.mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for j in range(rows):
        acc = ta.mix(acc ^ (part[:, j] + np.uint64(1)))
    return acc.view(np.int64)


def _sketch_batches(s: Similar):
    coordinates = s.rows * s.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if coordinates not in _CIRCULANT:
            _CIRCULANT[coordinates] = Circulant(coordinates)
        circulant = _CIRCULANT[coordinates]
        for batch in batches:
            for group in ta.groups(enumerate(ta.texts_of(batch.column(batch.schema.names.index("text"))))):
                words, offsets = ta.many_word_hashes([t for _, t in group], lower=True)
                sizes, prints, bands = [], [], []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    items = shingles(words[a:b], s.shingle)
                    sizes.append(len(items))
                    digest = xxhash.xxh3_128_digest(items.tobytes())
                    prints.append(np.frombuffer(digest, dtype=np.int64))
                    bands.append(_band_hashes(circulant.signature(items), s.bands, s.rows) if len(items) else [])
                keep = [batch.column(batch.schema.names.index(c)).slice(group[0][0], len(group)) for c in ("doc_id", "text_key")]
                yield pa.RecordBatch.from_arrays(
                    keep + [pa.array(sizes, pa.int64()), pa.array([p[0] for p in prints], pa.int64()),
                            pa.array([p[1] for p in prints], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "n_shingles", "p1", "p2", "bands"])
    return run


def _verify_batches(s: Similar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            last, last_set, linked = None, None, []
            for b, tb, ta_ in zip(col["b"].to_pylist(), ta.texts_of(col["text_b"]), ta.texts_of(col["text_a"])):
                if b != last:
                    last, last_set = b, shingles(ta.word_hashes(tb, lower=True), s.shingle)
                mine = shingles(ta.word_hashes(ta_, lower=True), s.shingle)
                both = len(np.intersect1d(mine, last_set, assume_unique=True))
                linked.append(100 * both >= s.percent * (len(mine) + len(last_set) - both))
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([col["a"].filter(keep), col["b"].filter(keep)], names=["a", "b"])
    return run


def sketches(docs: DataFrame, s: Similar) -> DataFrame:
    """Stored: row_id, doc_id, text_key, n_shingles, the 128-bit print of the set (p1, p2), band hashes."""
    src = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    out = arrow_map(src, _sketch_batches(s),
                    f"doc_id {kind}, text_key bigint, n_shingles bigint, p1 bigint, p2 bigint, bands array<bigint>")
    return stored(out.withColumn("row_id", F.monotonically_increasing_id()), "neardup_sketches")


def buckets(nodes: DataFrame) -> DataFrame:
    """Stored (bucket, node, met) of the buckets with two nodes or more; met: how
    often the node stands in a bucket with another, over all its buckets."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_ = stored(rows.join(shared, "bucket"), "neardup_shared")
    met = open_.groupBy("node").agg(F.sum("n").alias("met"))
    return stored(open_.drop("n").join(met, "node").select("bucket", "node", "met"), "neardup_buckets")


def centre_pairs(members: DataFrame, round_no: int) -> DataFrame:
    """(a, b): nodes and the centres of their buckets, where node and centre are
    in different components; per node the ``CENTRES`` centres met in most bands."""
    rank = -F.col("met") if round_no == 0 else F.xxhash64("node", F.lit(round_no))
    order = F.struct(rank.alias("p"), "node", "component")
    centre = members.groupBy("bucket").agg(F.min(order).alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("lo < hi").select("bucket", F.col("c.node").alias("b"), F.col("c.component").alias("cb"))
    shared = members.join(centre, "bucket").filter("component <> cb").groupBy(F.col("node").alias("a"), "b") \
        .agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    return shared.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= CENTRES).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, s: Similar) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return arrow_map(both.select("a", "b", "text_a", "text_b"), _verify_batches(s), "a bigint, b bigint")


def rooted(step: DataFrame) -> DataFrame:
    """(v, to) with every vertex sent to the root of its tree, from (v, to) with its parent (a root has itself):
    pointer jumping, as many rounds as the logarithm of the depth."""
    up = step.select(F.col("v").alias("to"), F.col("to").alias("next"))
    while True:
        jumped = stored(step.join(up, "to").select("v", F.col("next").alias("to"), (F.col("to") != F.col("next")).alias("moved")), "neardup_step")
        if jumped.filter("moved").isEmpty():
            return jumped.select("v", "to")
        step = jumped.select("v", "to")
        up = jumped.select(F.col("v").alias("to"), F.col("to").alias("next"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of undirected links (a, b): the smallest node.

    Rounds of contraction: every vertex points at its smallest neighbour, the trees that
    this makes are contracted to their roots, edges are rewritten to the roots and
    deduplicated, until none is left. A chain in the order of its ids is one tree.
    """
    edges = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                   "neardup_edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("to")),
                      "neardup_step")
        step = rooted(step)
        labels = stored(labels.join(step, F.col("component") == F.col("v"), "left")
                        .select("node", F.coalesce("to", "component").alias("component")), "neardup_labels")
        ends = edges.join(step.select(F.col("v").alias("a"), F.col("to").alias("ta")), "a") \
            .join(step.select(F.col("v").alias("b"), F.col("to").alias("tb")), "b")
        edges = stored(ends.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(),
                       "neardup_edges")
    return labels


def with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored (bucket, node, met, component) of the buckets that still hold nodes of different components."""
    m = members.select("bucket", "node", "met") \
        .join(labels.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left") \
        .select("bucket", "node", "met", F.coalesce("component", "node").alias("component"))
    mixed = m.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return stored(m.join(mixed.select("bucket"), "bucket", "left_semi"), "neardup_mixed")


def _shingle_batches(s: Similar):
    def rows(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.repeat([n for n, _ in found], [len(x) for _, x in found])),
                                           pa.array(np.concatenate([x for _, x in found]))], names=["node", "item"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            node = batch.column(batch.schema.names.index("node"))
            for i, text in enumerate(ta.texts_of(batch.column(batch.schema.names.index("text")))):
                items = shingles(ta.word_hashes(text, lower=True), s.shingle)
                found.append((node[i].as_py(), items.view(np.int64)))
                if sum(len(x) for _, x in found[-64:]) >= 50_000 or len(found) >= 64:
                    yield rows(found)
                    found = []
        if found:
            yield rows(found)
    return run


def remaining_pairs(members: DataFrame, texts: DataFrame, tested: DataFrame, s: Similar) -> DataFrame:
    """(a, b), a < b: nodes of different components that were not compared yet and
    can still reach the threshold t; nothing that could be linked is left out.

    The shingles are put in one order, fewest open nodes first. Two sets of similarity t share one
    of the first n - ceil(t n) + 1 of both. A shingle is rare if at most ``RARE`` open nodes have
    it. Of its n shingles a node shares at most m = n - (its rare ones) that are not rare; the rare
    ones that two nodes share are counted from the shingles (at most RARE^2 / 2 pairs each). So
    with c shared rare shingles the intersection is at most q = c + min(ma, mb) and
    the similarity at most q / (na + nb - q). Pairs without a common rare shingle share one of the first
    m - ceil(t n) + 1 that are not rare: they are joined on those. If the first one they share is number i of a and
    j of b, the intersection is at most 1 + min(ma - i, mb - j). Where that one is among the first ``HEAD`` of both,
    the pair is made on it alone.
    """
    homes = stored(members.groupBy("node").agg(F.max("component").alias("component")), "neardup_homes")
    items = arrow_map(texts.join(homes.select("node"), "node", "left_semi"), _shingle_batches(s), "node bigint, item bigint")
    items = stored(items, "neardup_items")
    counts = stored(items.groupBy("item").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "neardup_counts")
    size = items.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    known = stored(items.join(counts, "item"), "neardup_known")        # shingles of two nodes or more
    often = known.filter(F.col("k") > RARE).groupBy("node").agg(F.count(F.lit(1)).alias("m"))
    able = size.join(often, "node", "left").select("node", "n", F.coalesce("m", F.lit(0)).alias("m"))
    able = stored(homes.join(able, "node"), "neardup_able")
    side = lambda df, x: df.select(*[F.col(c).alias(f"{c}_{x}") for c in df.columns])
    other = (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))

    def reach(q):
        return q * 100 >= (F.col("n_a") + F.col("n_b") - q) * s.percent

    shared = known.filter(F.col("k") <= RARE).join(able, "node").drop("k")
    scarce_pairs = side(shared, "a").join(side(shared, "b"), (F.col("item_a") == F.col("item_b")) & other) \
        .groupBy("node_a", "node_b", "n_a", "n_b", "m_a", "m_b").agg(F.count(F.lit(1)).alias("c")) \
        .filter(reach(F.col("c") + F.least("m_a", "m_b"))).select("node_a", "node_b")

    first = F.expr(f"m - (n * {s.percent} + 99) div 100 + 1")
    order = Window.partitionBy("node").orderBy("k", "item")
    heads = known.filter(F.col("k") > RARE).join(able.filter(first > 0), "node") \
        .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= first).drop("k")
    heads = stored(heads, "neardup_heads")
    begin = heads.filter(F.col("r") <= HEAD).groupBy(F.col("node").alias("of")) \
        .agg(F.sort_array(F.collect_list(F.struct("r", "item")))["item"].alias("begin"))
    # of every two nodes of different components one is outside the largest component of their shingle
    top = heads.groupBy("item", "component").agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("item").agg(F.max(F.struct("c", "component"))["component"].alias("top"), F.count(F.lit(1)).alias("kinds")) \
        .filter("kinds > 1").select(F.col("item").alias("i"), "top")
    mixed = stored(heads.join(top, F.col("item") == F.col("i")).drop("i").join(begin, F.col("node") == F.col("of")).drop("of"), "neardup_mixed_heads")
    outside, both = mixed.filter("component <> top").drop("top"), F.array_intersect("begin_a", "begin_b")
    once = (F.size(both) == 0) | (F.get(both, F.lit(0)) == F.col("item_a"))
    twice = (F.col("component_b") != F.col("top_b")) & (F.col("node_a") > F.col("node_b"))     # both outside: made from the smaller one
    common = side(outside, "a").join(side(mixed, "b"), (F.col("item_a") == F.col("item_b")) & (F.col("component_a") != F.col("component_b"))
                                     & ~twice & reach(1 + F.least(F.col("m_a") - F.col("r_a"), F.col("m_b") - F.col("r_b"))) & once) \
        .select(F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b"))
    pairs = common.unionByName(scarce_pairs).distinct()
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).join(tested, ["a", "b"], "left_anti")


def groups(docs: DataFrame, s: Similar = Similar()) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, kept."""
    rows = sketches(docs, s)
    full = rows.filter("n_shingles > 0")
    sets = full.groupBy("p1", "p2").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("first_doc"))
    sets = stored(sets, "neardup_sets")
    nodes = full.join(sets.select(F.col("node").alias("row_id")), "row_id", "left_semi").withColumnRenamed("row_id", "node")
    members = buckets(nodes)
    texts = candidate_texts(docs, nodes, members)
    labels = linked(members, texts, s)
    # the group of every set, then of every row
    home = sets.join(labels.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left") \
        .select("p1", "p2", "first_doc", F.coalesce("component", "node").alias("component"))
    first = home.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    of_set = stored(home.join(first, "component").select("p1", "p2", "component_id"), "neardup_of_set")
    j = rows.drop("bands").join(of_set, ["p1", "p2"], "left")
    j = j.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return j.select("doc_id", "text_key", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def candidate_texts(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Stored (node, text) of the nodes that share a bucket with another, once per node
    however often its row is repeated: ``remaining_pairs`` counts shingles from it."""
    who = nodes.join(members.select("node").distinct(), "node", "left_semi") \
        .select("node", F.col("doc_id").alias("__id"), F.col("text_key").alias("__k"))
    src = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return stored(src.join(who, src.doc_id.eqNullSafe(F.col("__id")) & (src.text_key == F.col("__k")))
                  .select("node", "text").dropDuplicates(["node"]), "neardup_texts")


def linked(members: DataFrame, texts: DataFrame, s: Similar) -> DataFrame:
    """(node, component) of all nodes that have a link."""
    now = members.withColumn("component", F.col("node"))
    tested = links = labels = None
    for i in range(ROUNDS + 1):
        if i < ROUNDS:
            pairs = centre_pairs(now, i)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
        else:
            pairs = remaining_pairs(now, texts, tested, s)
        pairs = stored(pairs, "neardup_pairs")
        found = stored(verified(pairs, texts, s), "neardup_links")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = both if tested is None else tested.unionByName(both)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if i < ROUNDS:
            now = with_components(now, labels)
            if now.isEmpty():
                break
    return labels


def representatives(docs: DataFrame, s: Similar = Similar()) -> DataFrame:
    """One document (all columns) of every group: the one of the smallest doc_id.
    Of repeated rows of that document one stays."""
    i, k, n = (free(c, docs) for c in ("__id", "__k", "__n"))
    keep = groups(docs, s).filter("kept").groupBy(F.col("doc_id").alias(i), F.col("text_key").alias(k)) \
        .agg(F.count(F.lit(1)).alias(n))
    keep = stored(keep, "neardup_keep")
    rows = docs.join(keep, docs.doc_id.eqNullSafe(F.col(i)) & (F.xxhash64(docs.text) == F.col(k)))
    once = rows.filter(F.col(n) == 1).select(docs.columns)
    if keep.filter(F.col(n) > 1).isEmpty():
        return once
    return once.unionByName(rows.filter(F.col(n) > 1).dropDuplicates([i, k]).select(docs.columns))
