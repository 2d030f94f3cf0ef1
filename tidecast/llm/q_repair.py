"""op11: conversation structure repair of damaged conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repair


def damaged(df: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties
    its text, 2 removes its ``.!?``, 3 repeats it, 4 sets the role user."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    df = df.select("conv_id", "turn", k.alias("k"), filled("role").alias("role"), filled("text").alias("text")).filter("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copy = F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select("conv_id", "turn", role.alias("role"), text.alias("text"), copy.alias("copy")).drop("copy")


def op11_conversation_repair(spark, sf_dir):
    """Faults, cost, audit and digest of the repair of every conversation."""
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = repair.reports(damaged(df)).withColumnRenamed("conv_id", "c")
    every = df.select(F.col("conv_id").cast("bigint")).distinct()
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return every.join(out, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NONE = "{'c': 1000000000000, 'a': ''}"


def _ways(*ways: tuple[str, str, str]) -> str:
    """The smallest (cost, audit) among (state, cost, letters)."""
    return "list_min([" + ", ".join(f"{{'c': {s}.c + {c}, 'a': {s}.a || '{letters}'}}" for s, c, letters in ways) + "])"


# States of the recursion: g0 nothing yet, g1 after s, g2 after u, g3 after a; i0..i3 the same after inserts.
SQL = f"""
WITH RECURSIVE d0 AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
crc_table AS (
  SELECT b, t[9] AS v FROM (SELECT b, [b, 0, 0, 0, 0, 0, 0, 0, 0] AS seed,
    list_reduce(list_prepend([CAST(b AS BIGINT)], [[CAST(0 AS BIGINT)] FOR i IN range(8)]),
      lambda acc, x: list_append(acc, CASE WHEN acc[-1] % 2 = 1 THEN xor(acc[-1] >> 1, 3988292384) ELSE acc[-1] >> 1 END)) AS t
    FROM range(256) r(b))),
crcs AS (
  SELECT key, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(ch) AS BIGINT) FOR ch IN string_split(key, '')]),
      lambda acc, x: xor(acc >> 8, tab[xor(acc & 255, x) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT key FROM d0), (SELECT list(v ORDER BY b) AS tab FROM crc_table)),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT d0.*, crc % 20 AS k FROM d0 JOIN crcs USING (key)), range(2) c(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn,
         right(rtrim(text, {_SPACE}), 1) AS e, left(role, 1) AS initial FROM d),
r AS (
  SELECT *, CASE WHEN e = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'd'
                 WHEN e IN ('.', '!', '?') THEN '' ELSE 't' END AS kind,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS two, count(*) OVER (PARTITION BY conv_id) AS n FROM placed),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'b') AS blank,
         count(*) FILTER (kind = 'd') AS duplicate, count(*) FILTER (kind = 't') AS truncated,
         count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
walk(conv_id, rn, n, g0, g1, g2, g3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), n, {{'c': CAST(0 AS BIGINT), 'a': ''}}, {_NONE}::STRUCT(c BIGINT, a VARCHAR),
         {_NONE}::STRUCT(c BIGINT, a VARCHAR), {_NONE}::STRUCT(c BIGINT, a VARCHAR) FROM (SELECT DISTINCT conv_id, n FROM r)
  UNION ALL
  SELECT conv_id, rn, n, {_ways(("i0", "2", "D"))},
         list_min([{{'c': i1.c + 2, 'a': i1.a || 'D'}}, {{'c': i0.c + keep_s, 'a': i0.a || 'K'}}]),
         list_min([{{'c': i2.c + 2, 'a': i2.a || 'D'}},
                   {", ".join(f"{{'c': {s}.c + keep_u, 'a': {s}.a || 'K'}}, {{'c': {s}.c + rerole, 'a': {s}.a || 'R'}}" for s in ("i0", "i1", "i3"))}]),
         list_min([{{'c': i3.c + 2, 'a': i3.a || 'D'}}, {{'c': i2.c + keep_a, 'a': i2.a || 'K'}}, {{'c': i2.c + rerole, 'a': i2.a || 'R'}}])
  FROM (SELECT w.conv_id, r.rn, w.n, w.g0 AS i0, w.g1 AS i1,
               {_ways(("w.g2", "0", ""), ("w.g0", "5", "I"), ("w.g1", "5", "I"), ("w.g3", "5", "I"))} AS i2,
               {_ways(("w.g3", "0", ""), ("w.g2", "5", "I"), ("w.g0", "10", "II"), ("w.g1", "10", "II"))} AS i3,
               CASE WHEN kind IN ('b', 'd') THEN 1000000000000 WHEN kind = 't' THEN 5 ELSE 0 END AS stay,
               stay + CASE WHEN initial = 's' THEN 0 ELSE 1000000000000 END AS keep_s,
               stay + CASE WHEN initial = 'u' THEN 0 ELSE 1000000000000 END AS keep_u,
               stay + CASE WHEN initial = 'a' THEN 0 ELSE 1000000000000 END AS keep_a, stay + 1 AS rerole
        FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.rn = w.rn + 1)),
best AS (
  SELECT conv_id, {_ways(("g0", "0", ""), ("g3", "0", ""), ("g2", "5", "I"), ("g0", "10", "II"), ("g1", "10", "II"))} AS b
  FROM walk WHERE rn = n),
letters AS (SELECT conv_id, p, b.a[p] AS letter FROM best, unnest(range(1, length(b.a) + 1)) u(p)),
numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS rn,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS put FROM letters),
out_ AS (
  SELECT x.*, r.role, r.text, r.initial, max(CASE WHEN x.put = 1 AND letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY x.conv_id) AS lead_
  FROM numbered x LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.rn = x.rn AND x.letter <> 'I' WHERE letter <> 'D'),
told AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (put - lead_) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                             coalesce(text, ''), chr(10) ORDER BY p) AS body FROM out_ GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
       coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal, CAST(coalesce(b.b.c, 0) AS BIGINT) AS cost,
       coalesce(b.b.a, '') AS audit, sha256(coalesce(t.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM d0) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""
