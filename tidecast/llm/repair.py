"""Conversation structure repair by generalised LR parsing with edits.

Method. The rows of a conversation, by turn (null turns first; rows of one turn by role,
then text), run through the parser of ``rolegrammar``: a graph-structured stack over the
role grammar, actions keep (0), rerole (1), delete (2) and insert (5), equal stack tops
merged into the smallest (cost, audit). A row is blank (no character but spaces and
controls 9 to 13), else a duplicate (role and text of an earlier row), else truncated (does not
end in one of ``.!?``); blank and duplicate rows must be deleted, a truncated row that stays
adds 5.

Plan. A count per conversation, partial before its shuffle, tells conversations of at
most ``MAX_ROWS`` rows and ``MAX_CHARS`` characters from larger ones. The first are
shuffled by conversation, sorted within the task and parsed as a stream: a task
holds one conversation at a time. A larger conversation is never gathered: equal rows are
counted first, the rows are range-partitioned by their place, and every stretch of
at most ``STRETCH`` rows of one task is parsed from each of the stack tops that can
precede it. Stretches then compose like matrices over (cost, audit); that works
because audits after a row order by (audit before, letters since). Of such a
conversation only the audit, a letter per row, is gathered, as it is a column of the
result. Its digest is by definition one pass over all of its repaired rows in order: one task
streams them, with a batch of rows in memory.

Defined results. Null roles and texts count as one space. A role whose first letter is
none of s, u, a cannot be kept. A null ``conv_id`` is a conversation like others. Repeated
rows are rows: the second is a duplicate. All turns null: no gaps. Empty table: no
rows. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolegrammar as grammar
from .tables import arrow_map, small, stored

MAX_ROWS = 4096
MAX_CHARS = 1 << 24
STRETCH = 1 << 16
BLANK = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
REPAIRED = "conv_id bigint, position bigint, role string, text string, edit string"


def _rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                     F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def _kind(text: str) -> str:
    """b (blank), t (truncated) or nothing."""
    end = text.rstrip(BLANK)
    return "b" if not end else "" if end[-1] in ".!?" else "t"


class _Digest:
    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True


class _Conversation:
    """Rows of one conversation, held and parsed."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.rows, self.kinds = conv_id, [], [], []
        self.seen, self.parse = set(), grammar.Parse()
        self.illegal = 0

    def add(self, turn, role: str, text: str) -> None:
        kind = _kind(text)
        if not kind == "b":
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if key in self.seen:
                kind = "d"
            self.seen.add(key)
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + role[:1] not in LEGAL
        if turn is not None:
            self.turns.append(turn)
        self.rows.append((role, text))
        self.kinds.append(kind)
        self.parse.row(role[:1], kind in ("b", "d"), kind == "t")

    def repaired(self, audit: str, roles: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the rows that stay or come in."""
        rows, put = iter(self.rows), iter(roles)
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit != "D":
                initial = next(put)
                yield (role if edit == "K" else grammar.ROLES[initial]), text, edit

    def report(self) -> tuple:
        cost, audit, roles = self.parse.finish()
        digest = _Digest()
        for role, text, _ in self.repaired(audit, roles):
            digest.add(role, text)
        t = self.turns
        gaps = max(t) - min(t) + 1 - len(set(t)) if t else 0
        return (self.conv_id, gaps, *(self.kinds.count(k) for k in "bdt"), self.illegal, cost, audit, digest.sha.hexdigest())

    def result(self) -> Iterator[tuple]:
        _, audit, roles = self.parse.finish()
        for k, (role, text, edit) in enumerate(self.repaired(audit, roles)):
            yield self.conv_id, k, role, text, edit


def _conversations(batches) -> Iterator[_Conversation]:
    """The conversations of sorted rows, one at a time."""
    now = None
    for b in batches:
        for conv_id, *row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                now = _Conversation(conv_id)
            now.add(*row)
    if now is not None:
        yield now


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in text.split(", "))])


def _by_conversation(rows: DataFrame, one, schema: str) -> DataFrame:
    """``one`` (a conversation to result rows) over conversations of bounded size."""
    def run(batches):
        return _batched((r for c in _conversations(batches) for r in one(c)), _schema(schema))
    return arrow_map(rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"), run, schema)


# conversations of any size ----------------------------------------------------------------------

PLACED = "conv_id bigint, turn bigint, role string, text string, copies bigint, kind string, stretch bigint, pos bigint"
STRETCHES = ("conv_id bigint, pos bigint, start int, top int, cost bigint, audit string, roles string, blank bigint, duplicate bigint, "
             "truncated bigint, illegal bigint, first string, last string")


def _placed(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, kind and place (``pos`` grows along every conversation)."""
    r = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), "repair_rows")
    r = r.withColumn("end", F.right(F.rtrim(F.col("text"), F.lit(BLANK)), F.lit(1)))
    full = r.filter("end <> ''").withColumns({"key": F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256),
                                              "at": F.struct(F.col("turn").isNotNull(), "turn")})
    first = full.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min("at").alias("first"))
    full = full.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")))
    kind = F.when(F.col("at") > F.col("first"), "d").when(F.col("end").isin(".", "!", "?"), "").otherwise("t")
    columns = ["conv_id", "turn", "role", "text", "copies"]
    known = full.select(*columns, kind.alias("kind")).unionByName(r.filter("end = ''").select(*columns, F.lit("b").alias("kind")))
    place = ["conv_id", "turn", "role"]
    return stored(known.repartitionByRange(*place, F.substring("text", 1, 256)).sortWithinPartitions(*place, "text")
                  .select("*", F.spark_partition_id().cast("bigint").alias("stretch"), F.monotonically_increasing_id().alias("pos")),
                  "repair_placed")


def _copies(kind: str, n: int) -> Iterator[str]:
    """The kinds of the n copies of a row: all after the first are duplicates, unless blank."""
    yield kind
    for _ in range(n - 1):
        yield "b" if kind == "b" else "d"


def _stretches(batches) -> Iterator[tuple]:
    """Each stretch parsed from every stack top that can precede it."""
    def done():
        for start, parse in parses:
            for top, cost, audit, roles in parse.ends():
                yield (conv, pos, start, top, cost, audit, roles, *counts, illegal, first, last)

    parses = None
    for b in batches:
        for c, s, p, role, kind, copies in zip(*(b.column(x).to_pylist() for x in ("conv_id", "stretch", "pos", "role", "kind", "copies"))):
            if parses is None or (c, s) != (conv, stretch) or n >= STRETCH:
                if parses is not None:
                    yield from done()
                conv, stretch, pos, n, counts, illegal, first, last = c, s, p, 0, [0, 0, 0], 0, role[:1], None
                parses = [(stack[-1], grammar.Parse(stack)) for stack in grammar.tops_of_all_prefixes()]
            for k in _copies(kind, copies):
                if k:
                    counts["bdt".index(k)] += 1
                illegal += last is not None and last + role[:1] not in LEGAL
                last = role[:1]
                n += 1
                for _, parse in parses:
                    parse.row(role[:1], k in ("b", "d"), k == "t")
    if parses is not None:
        yield from done()


def _composed(pieces) -> tuple[int, str, str]:
    """Cost, audit and initials of a conversation from its stretches in order."""
    best = {0: (0, "", "")}
    for piece in pieces:
        after: dict[int, tuple] = {}
        for start, top, cost, audit, roles in piece:
            if start in best:
                c, a, r = best[start]
                way = (c + cost, a + audit, r + roles)
                if top not in after or way[:2] < after[top][:2]:
                    after[top] = way
        best = after
    stacks = {s[-1]: s for s in grammar.tops_of_all_prefixes()}
    ends = []
    for top, (cost, audit, roles) in best.items():
        more, _, letters, out = grammar.closing(((stacks[top], 0, 0),))
        ends.append((cost + more, audit + letters, roles + out))
    return min(ends)


def _compose(pdf):
    """One conversation's stretches to its report without digest and gaps."""
    import pandas as pd
    pieces = [list(zip(p.start, p.top, p.cost, p.audit, p.roles)) for _, p in pdf.groupby("pos", sort=True)]
    ones = pdf.sort_values("pos").drop_duplicates("pos")
    edges = sum(a + b not in LEGAL for a, b in zip(ones["last"].iloc[:-1], ones["first"].iloc[1:]))
    cost, audit, roles = _composed(pieces)
    conv = ones.conv_id.iloc[0]
    return pd.DataFrame({"conv_id": [None if pd.isna(conv) else int(conv)], "blank": [int(ones.blank.sum())],
                         "duplicate": [int(ones.duplicate.sum())], "truncated": [int(ones.truncated.sum())],
                         "illegal": [int(ones.illegal.sum() + edges)], "cost": [cost], "audit": [audit], "roles": [roles]}
                        ).astype({"conv_id": "Int64"})


def _edited(batches) -> Iterator[tuple]:
    """(conv_id, role, text, edit, None) of every row that stays, from sorted rows led by the audit's row.
    An inserted row follows its place; at the end of a conversation (conv_id, None, None, None, True) follows."""
    conv, audit, roles, k, p, open_ = None, "", "", 0, 0, False

    def inserts():
        nonlocal k, p
        while k < len(audit) and audit[k] == "I":
            yield conv, grammar.ROLES[roles[p]], "", "I", None
            k, p = k + 1, p + 1

    for b in batches:
        for c, pos, role, text, copies, a, r in zip(*(b.column(x).to_pylist() for x in ("conv_id", "pos", "role", "text", "copies", "audit", "roles"))):
            if pos < 0:
                if open_:
                    yield from inserts()
                    yield conv, None, None, None, True
                conv, audit, roles, k, p, open_ = c, a, r, 0, 0, True
                continue
            for _ in range(copies):
                yield from inserts()
                edit = audit[k]
                k += 1
                if edit != "D":
                    yield conv, (role if edit == "K" else grammar.ROLES[roles[p]]), text, edit, None
                    p += 1
    if open_:
        yield from inserts()
        yield conv, None, None, None, True


def _large(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports without gaps and digest, placed rows led by the audits) of conversations of any size."""
    placed = _placed(rows)
    pieces = stored(arrow_map(placed.select("conv_id", "stretch", "pos", "role", "kind", "copies").repartition("stretch")
                              .sortWithinPartitions("stretch", "pos"),
                              lambda batches: _batched(_stretches(batches), _schema(STRETCHES)), STRETCHES), "repair_stretches")
    reports = stored(pieces.groupBy("conv_id").applyInPandas(
        _compose, "conv_id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, roles string"),
        "repair_composed")
    none = F.lit(None).cast("string")
    led = (reports.select("conv_id", F.lit(-1).cast("bigint").alias("pos"), none.alias("role"), none.alias("text"),
                          F.lit(0).cast("bigint").alias("copies"), "audit", "roles")
           .unionByName(placed.select("conv_id", "pos", "role", "text", "copies", none.alias("audit"), none.alias("roles"))))
    return reports, led.repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def _large_reports(rows: DataFrame) -> DataFrame:
    reports, led = _large(rows)

    def digests(batches):
        def run():
            digest = _Digest()
            for conv, role, text, _, over in _edited(batches):
                if over:
                    yield conv, digest.sha.hexdigest()
                    digest = _Digest()
                else:
                    digest.add(role, text)
        return _batched(run(), _schema("conv_id bigint, repaired_sha256 string"))

    sha = arrow_map(led, digests, "conv_id bigint, repaired_sha256 string").withColumnRenamed("conv_id", "c1")
    turns = (rows.select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("c2"))
             .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")))
    return (reports.join(sha, F.col("conv_id").eqNullSafe(F.col("c1"))).join(turns, F.col("conv_id").eqNullSafe(F.col("c2")))
            .select(*[f.split()[0] for f in REPORT.split(", ")]))


def _large_result(rows: DataFrame) -> DataFrame:
    _, led = _large(rows)

    def result(batches):
        def run():
            k = 0
            for conv, role, text, edit, over in _edited(batches):
                if not over:
                    yield conv, k, role, text, edit
                k = 0 if over else k + 1
        return _batched(run(), _schema(REPAIRED))
    return arrow_map(led, result, REPAIRED)


def _routed(df: DataFrame, one, schema: str, large) -> DataFrame:
    rows = _rows(df)
    hot = stored(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
                 .filter((F.col("n") > MAX_ROWS) | (F.col("chars") > MAX_CHARS)).select(F.col("conv_id").alias("hot")), "repair_large")
    if hot.isEmpty():
        return _by_conversation(rows, one, schema)
    same = F.col("conv_id").eqNullSafe(F.col("hot"))
    return _by_conversation(rows.join(small(hot), same, "left_anti"), one, schema).unionByName(
        large(rows.join(small(hot), same, "left_semi")))


def reports(df: DataFrame) -> DataFrame:
    """Per conversation of ``df`` (conv_id, turn, role, text): faults, cost, audit and digest of the repair, see ``REPORT``."""
    return _routed(df, lambda c: [c.report()], REPORT, _large_reports)


def repaired(df: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, see ``REPAIRED`` (``position`` from 0, ``edit``: K, R or I)."""
    return _routed(df, _Conversation.result, REPAIRED, _large_result)
