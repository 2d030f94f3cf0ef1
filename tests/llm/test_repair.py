"""Conversation repair against a search over all edits, on both routes, odd rows included."""

import hashlib
import random
import re
import sys
import zlib

import pytest

from tidecast.llm import q_repair, repair, rolegrammar

GOAL = re.compile(r"(s?(ua)+)?")
SPACE = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, pos bigint, copies bigint, audit string, c bigint, hot bigint"
CLASH = ("k", -1, -1, "x", -1, -1)


def cheapest(rows):
    """(cost, audit, roles) over all edits of (initial, must go, truncated) rows, two inserts at most in a row."""
    found = []

    def go(k, cost, audit, out):
        if found and cost > found[0][0]:
            return
        for n, more in ((0, ""), (1, "u"), (1, "a"), (2, "ua"), (2, "au")):
            c, a, o = cost + 5 * n, audit + "I" * n, out + more
            if k == len(rows):
                if GOAL.fullmatch(o) and (not found or (c, a) < found[0][:2]):
                    found[:] = [(c, a, o)]
                continue
            initial, must, cut = rows[k]
            go(k + 1, c + 2, a + "D", o)
            if not must:
                if initial and initial in "sua":
                    go(k + 1, c + 5 * cut, a + "K", o + initial)
                for t in "ua":
                    go(k + 1, c + 1 + 5 * cut, a + "R", o + t)
    go(0, 0, "", "")
    return found[0]


def expected(table, damage=False):
    """Report rows of (conv_id, turn, role, text) rows, by plain Python."""
    groups = {c: [] for c, *_ in table}
    for c, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[c] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = []
    for c, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds, seen = [], set()
        for _, role, text in rows:
            ends = SPACE.findall(text)
            kinds.append("b" if not ends else "d" if (role, text) in seen else "" if ends[-1] in ".!?" else "t")
            seen.add((role, text))
        cost, audit, roles = cheapest([(role[:1], k in ("b", "d"), k == "t") for (_, role, _), k in zip(rows, kinds)])
        body, left, put = [], iter(rows), iter(roles)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(left)
            if e != "D":
                t = next(put)
                body.append((role if e == "K" else {"u": "user", "a": "assistant"}[t]) + ":" + text)
        turns = [t for t, *_ in rows if t is not None]
        two = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in "bdt"),
                    sum(t not in ("su", "ua", "au") for t in two), cost, audit, hashlib.sha256("\n".join(body).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed=3, n=60):
    rng = random.Random(seed)
    texts = ["a b.", "a b.", "so!", "why?", "cut off", "", " \t\n", "é 本.", "x" * 3000 + ".", "dots . ", "q?"]
    rows = []
    for c in range(n):
        rows += [(rng.choice([c, c, None if c % 9 == 0 else c]) if c % 9 == 0 else c, rng.choice([k, k, k, k + 1, None]),
                  rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]),
                  rng.choice([*texts, None, f"own {k}."])) for k in range(rng.randint(1, 5))]
    return rows + rows[:7]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_parser_finds_the_cheapest_edits():
    rng = random.Random(8)
    for _ in range(300):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.random() < .2, rng.random() < .25) for _ in range(rng.randint(0, 5))]
        p = rolegrammar.Parse()
        for r in rows:
            p.row(*r)
        assert p.finish() == cheapest(rows), rows


def test_equal_tops_have_equal_futures():
    def reach(stack, word):
        now = {stack}
        for t in word:
            now = {n for s in now for n in rolegrammar.shifted(s, t)}
        return any(map(rolegrammar.accepted, now))
    words = [""] + [a + b + c + d for a in "sua" for b in ("s", "u", "a", "") for c in ("s", "u", "a", "") for d in ("u", "a", "")]
    stacks, edge = {(0,)}, [(0,)]
    while edge:
        edge = [n for s in edge for t in "sua" for n in rolegrammar.shifted(s, t) if n not in stacks]
        stacks.update(edge)
    by_top = {s[-1]: s for s in rolegrammar.tops_of_all_prefixes()}
    assert {s[-1] for s in stacks} == set(by_top) and len(stacks) > len(by_top)
    for s in stacks:
        assert all(reach(s, w) == reach(by_top[s[-1]], w) for w in words)


def test_reports_against_brute_force(spark):
    rows = conversations()
    assert got(repair.reports(frame(spark, rows))) == expected(rows)


@pytest.mark.parametrize("stretch", [1, 3])
def test_conversations_beyond_one_task(spark, monkeypatch, stretch):
    rows = conversations(seed=4, n=30) + [(7, None, "user", "a b.")] * 5 + [(7, 2, "tool", " ")] * 4
    monkeypatch.setattr(repair, "MAX_ROWS", 2)
    monkeypatch.setattr(repair, "STRETCH", stretch)
    df = frame(spark, [r for r in rows if r[0] != 7] + [r for r in rows if r[0] == 7][:5])
    rows = [r for r in rows if r[0] != 7] + [r for r in rows if r[0] == 7][:5]
    assert got(repair.reports(df)) == expected(rows)
    many = got(repair.repaired(df))
    monkeypatch.setattr(repair, "MAX_ROWS", 4096)
    assert many == got(repair.repaired(df))


def test_one_long_conversation(spark, monkeypatch):
    roles = ["user", "assistant"]
    rows = [(1, k, "system" if k == 700 else roles[k % 2], "same." if k % 50 == 3 else f"t{k}" if k % 7 == 0 else f"t{k}.") for k in range(3000)]
    rows += [(2, 0, "user", "hi.")] * 1500
    whole = got(repair.reports(frame(spark, rows)))
    monkeypatch.setattr(repair, "MAX_ROWS", 100)
    monkeypatch.setattr(repair, "STRETCH", 64)
    assert got(repair.reports(frame(spark, rows))) == whole
    assert {r[0]: r[3] for r in whole}[2] == 1499 and sys.getsizeof(whole[0][7]) > 3000


def test_query_on_odd_tables(spark, tmp_path):
    rows = conversations(seed=9, n=80) + [(5000 + k, 1, "user", "only one.") for k in range(40)]
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    out = got(q_repair.op11_conversation_repair(spark, str(tmp_path)))
    assert out == expected(rows, damage=True)
    empty_sha = hashlib.sha256(b"").hexdigest()
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", empty_sha) for r in out)

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert sorted(con.execute(q_repair.SQL).fetchall(), key=repr) == out


def test_empty_table(spark):
    assert got(repair.reports(frame(spark, []).limit(0))) == [] == got(repair.repaired(frame(spark, [])))
