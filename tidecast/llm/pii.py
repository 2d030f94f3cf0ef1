"""Personal data: pattern spans plus information-theoretic sanitisation.

Method. Four patterns find protected entities (e-mail, IP address, card and
phone number). Words of a text can give an entity away, so the corpus decides
which: entity e stands for the whole entity or for a part of it (``keys``), so
that an entity of a single text shares the texts of its parts. For a word t of
the texts that hold e, pointwise mutual information PMI(e; t) =
log p(e, t) / (p(e) p(t)) is set against the information of the entity, IC(e) =
-log p(e). Document frequencies over the whole corpus (each distinct text once,
whole texts) give the probabilities. Where PMI >= alpha * IC and the pair was
seen in ``min_support`` texts, t discloses e, and every occurrence of t in every
document that holds e gets a span of kind ``term``: at PMI >= ``remove_at`` * IC it
is removed, below that it is generalised to a class label. In a document that
does not hold e the word stays: there is nothing there that it could disclose.

Plan. DataFrame functions only. Span positions come from the lengths of the
pieces between matches and of the matches, computed within the row and only for
texts that match. Words are taken only of texts with an entity of ``min_support``
texts, each distinct word once per text; words too frequent for any entity go
before pairs are made, and pairs are counted by two-step aggregation. Frequencies
of the candidate words over all documents join on the word: broadcast after the
candidates have been counted (``tables.small``), else by a shuffle join.

Pattern notes (all equal to leftmost non-overlapping search): a run that cannot
match is left at once by look-behind, ``\\G`` keeps a match possible directly
after the previous one, and possessive loops keep the matcher from recursing on
texts of any length.

Defined results. Null text: no spans. Equal rows: one result each. Null or
repeated doc_ids: rows are told apart by their text. Empty table: no rows.
Positions are code points, end exclusive.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free, small, stored

KINDS = ["email", "ip", "card", "phone", "term"]

_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A literal that every match holds, asked for before the pattern is run (None: ask the pattern).
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Context words: runs of letters and digits, of at least three characters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Disclosure:
    min_support: int = 3      # distinct texts in which word and entity stand together
    alpha: float = 0.8        # share of the entity's information that a word must carry
    remove_at: float = 0.95   # ... and above which it is removed, not generalised
    min_chars: int = 3


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, 1).cast("int")  # noqa: E731  i-th digit from the right
    twice = lambda v: F.when(v > 4, v * 2 - 9).otherwise(v * 2)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0),
                        lambda acc, i: acc + F.when(i % 2 == 1, twice(value(i))).otherwise(value(i)))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(14, 19), luhn(_digits(m))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def placed(text: Column, pattern: str | Column, kind: int, valid=None) -> Column:
    """The matches of a pattern as spans (start, kind, end, value), in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("value"))
        keep = valid(x["m"]) if valid else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    spans = F.aggregate(pairs, zero, step)["out"]
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Every valid pattern match, by start, then kind as listed."""
    parts = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        need = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9][ -]?[0-9]")
        spans = placed(text, pattern, i, lambda m, kind=kind: _valid(kind, m))
        parts.append(F.when(need, spans).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*parts))


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base: the stored spans of the documents that have any (each distinct row once)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text"))).filter(F.size("base") > 0)
    return stored(rows.withColumn("text_key", F.xxhash64("text")).dropDuplicates(["doc_id", "text_key"]), "pii_base")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span overwritten by blanks (same length)."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        ahead = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(ahead, blank)).alias("out"))

    parts = F.aggregate(spans, zero, step)
    return F.concat(F.array_join(parts["out"], ""), F.substring(text, parts["at"] + 1, F.length(text)))


def keys(e: Column) -> Column:
    """What a span is counted under: the entity itself and the parts it shares with others:
    of an e-mail the domain and the words of the local part, of an IP address the first three
    octets, of a card the first six digits, of a phone number all but the last four."""
    value = ascii_lower(e["value"])
    kind = lambda k: e["kind"] == KINDS.index(k)
    named = lambda k, part: F.concat(F.lit(f"{k}:"), part)
    local = F.filter(F.split(F.substring_index(value, "@", 1), NO_WORD), lambda w: F.length(w) >= 3)
    parts = F.when(kind("email"), F.concat(F.array(named("domain", F.substring_index(value, "@", -1))),
                                           F.transform(local, lambda w: named("local", w)))) \
        .when(kind("ip"), F.array(named("net", F.substring_index(value, ".", 3)))) \
        .when(kind("card"), F.array(named("issuer", F.substring(_digits(value), 1, 6)))) \
        .otherwise(F.array(named("block", F.substring(_digits(value), F.lit(1), F.length(_digits(value)) - 4))))
    return F.array_distinct(F.concat(F.array(F.concat_ws(":", e["kind"], value)), parts))


def holders(found: DataFrame) -> DataFrame:
    """Stored (text_key, entity): the entities and parts of entities that each distinct text holds."""
    held = found.select("text_key", F.explode(F.array_distinct(F.flatten(F.transform("base", keys)))).alias("entity"))
    return stored(held.distinct(), "pii_holders")


def words_of(texts: DataFrame, d: Disclosure) -> DataFrame:
    """(text_key, term): the distinct words of whole texts, outside every base span."""
    split = F.split(ascii_lower(masked(F.col("text"), F.col("base"))), NO_WORD)
    kept = F.filter(F.array_distinct(split), lambda w: F.length(w) >= d.min_chars)
    return texts.select("text_key", F.explode(kept).alias("term")).distinct()


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): distinct texts of the whole corpus that have each of the given terms."""
    tokens = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
                         F.explode(F.array_distinct(F.split(ascii_lower(F.col("text")), NO_WORD))).alias("term"))
    return tokens.join(small(terms), "term", "left_semi").groupBy("term").agg(F.count_distinct("text_key").alias("n_t"))


def disclosing(docs: DataFrame, found: DataFrame, held: DataFrame, d: Disclosure) -> DataFrame:
    """Stored (entity, term, share): the words that disclose an entity and the share PMI / IC."""
    total = docs.agg(F.count_distinct(F.xxhash64(F.coalesce("text", F.lit("")))).alias("n"))
    # no pair has more texts than its entity
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") >= d.min_support)
    entities = stored(entities.withColumn("n", total.scalar()), "pii_entities")
    open_held = stored(held.join(small(entities), "entity"), "pii_open_held")
    # PMI >= alpha * IC holds only up to this corpus frequency of the word; words that stand
    # in more of the texts at hand than that are out before they are paired
    most = lambda n_et: n_et * F.pow(F.col("n") / F.col("n_e"), F.lit(1 - d.alpha)) * 1.000001
    texts = found.join(small(open_held.select("text_key").distinct()), "text_key", "left_semi")
    words = stored(words_of(texts, d), "pii_words")
    nearby = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_near")) \
        .join(F.broadcast(entities.agg(F.max(most(F.col("n_e"))).alias("top"))), (F.col("n_near") >= d.min_support) & (F.col("n_near") <= F.col("top")))
    words = words.join(small(stored(nearby.drop("top"), "pii_nearby")), "term")
    open_ = open_held.join(words, "text_key").filter(F.col("n_near") <= most(F.col("n_e"))) \
        .groupBy("entity", "term", "n_e", "n", "n_near").agg(F.count(F.lit(1)).alias("n_et")) \
        .filter((F.col("n_et") >= d.min_support) & (F.col("n_near") <= most(F.col("n_et")))).drop("n_near")
    open_ = stored(open_, "pii_pairs")
    freq = term_frequencies(docs, open_.select("term").distinct())
    j = open_.join(freq, "term")
    pmi = F.log(F.col("n_et") * F.col("n") / (F.col("n_e") * F.col("n_t")))
    share = F.try_divide(pmi, F.log(F.col("n") / F.col("n_e")))
    return stored(j.select("entity", "term", share.alias("share")).filter(F.col("share") >= d.alpha), "pii_disclosing")


def term_spans(text: Column, base: Column, shares: Column, d: Disclosure) -> Column:
    """Every occurrence of the words of ``shares`` (term -> share) in the text, outside
    every base span, as spans whose value is removed or generalised."""
    clear = ascii_lower(masked(text, base))
    # words hold no sign that means something in a pattern
    pattern = F.concat(F.lit(f"(?<!{WORD[:-1]})(?:"), F.array_join(F.map_keys(shares), "|"), F.lit(f")(?!{WORD[:-1]})"))
    return F.transform(placed(clear, pattern, KINDS.index("term")), lambda w: F.struct(
        w["start"].alias("start"), w["kind"].alias("kind"), w["end"].alias("end"),
        F.when(F.element_at(shares, w["value"]) >= d.remove_at, "removed").otherwise("generalised").alias("value")))


def spans(docs: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, text_key, base, spans of every document with personal data. ``spans``
    holds base and term spans by start, then kind; value of a term: removed or generalised."""
    found = with_base(docs)
    held = holders(found)
    hit = held.join(disclosing(docs, found, held, d), "entity").groupBy("text_key", "term").agg(F.max("share").alias("share"))
    per = hit.groupBy(F.col("text_key").alias("__k")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    j = found.join(per, found.text_key == F.col("__k"), "left")
    terms = F.when(F.col("shares").isNotNull(), term_spans(F.col("text"), F.col("base"), F.col("shares"), d))
    all_spans = F.array_sort(F.concat("base", F.coalesce(terms, F.array().cast(_SPAN))))
    return j.select("doc_id", "text_key", "base", all_spans.alias("spans"))


def attached(docs: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:
    """The documents, all columns, with ``__base`` and ``__spans`` (empty where nothing was found; input columns
    of these two names are replaced)."""
    i, k = free("__id", docs), free("__k", docs)
    docs = docs.drop("__base", "__spans")
    s = spans(docs, d).select(F.col("doc_id").alias(i), F.col("text_key").alias(k),
                              F.col("base").alias("__base"), F.col("spans").alias("__spans"))
    j = docs.join(s, docs.doc_id.eqNullSafe(F.col(i))
                  & (F.xxhash64(F.coalesce(docs.text, F.lit(""))) == F.col(k)), "left").drop(i, k)
    none = F.array().cast(_SPAN)
    return j.withColumn("__base", F.coalesce("__base", none)).withColumn("__spans", F.coalesce("__spans", none))


def joined(spans_col: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:
    """The documents with every span replaced: base spans by their kind, disclosing
    words by [TERM] or by nothing. Overlapping spans are replaced as one, by the first."""
    old = {c: free(f"{c}_input", docs) for c in docs.columns if c in ("__base", "__spans")}
    columns = docs.columns
    docs = docs.withColumnsRenamed(old)
    rows = attached(docs, d)
    kinds = F.array(*[F.upper(F.lit(k)) for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        ahead = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        label = F.when(s["value"] == "removed", "").otherwise(F.concat(F.lit("["), F.get(kinds, s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(ahead, label)))
                        .otherwise(acc["out"]).alias("out"))

    parts = F.aggregate("__spans", zero, step)
    text = F.concat(F.array_join(parts["out"], ""), F.substring(F.col("text"), parts["at"] + 1, F.length("text")))
    return rows.withColumn("text", F.when(F.size("__spans") > 0, text).otherwise(F.col("text"))) \
        .select([F.col(old.get(c, c)).alias(c) for c in columns])
