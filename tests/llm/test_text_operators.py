"""Operators on whole texts against brute force, odd rows included."""

import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import corpus

from tidecast.llm import (decontaminate, langid, neardup, packing, pii, q_packing, q_pii, q_tokencount, quality, substrings,
                          textarrays, tokencount)

#: Repeated rows: one row twice, one id with two texts, null ids.
ODD = [(0, "x y"), (3, "x y"), (3, "other words here"), (None, "x y"), (None, None), (None, "lonely words of nobody")]


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_word_hashes_agree_with_words(rows):
    for _, t in rows:
        w = brute.words(t)
        h = textarrays.word_hashes(t.encode() if t else None)
        assert len(h) == len(w) and len(set(h.tolist())) == len(set(w))
    texts = [t.encode() if t else None for _, t in rows]
    h, off = textarrays.many_word_hashes(texts)
    assert np.array_equal(h, np.concatenate([textarrays.word_hashes(t) for t in texts]))
    assert off[-1] == len(h) and len(off) == len(texts) + 1


def test_word_hashes_of_a_text_in_pieces(monkeypatch):
    text = corpus()[-3][1].encode()
    whole = textarrays.word_hashes(text)
    monkeypatch.setattr(textarrays, "CHUNK", 100)
    assert np.array_equal(textarrays.word_hashes(text), whole)


def test_token_counts(make, rows, empty):
    import sentencepiece
    path = q_tokencount.model_path()
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    cost = {}
    for i, p in enumerate(pieces):
        cost.setdefault(p, math.log(i + 2))
    longest, known = max(map(len, cost)), {}

    def count(w):
        if w not in known:
            known[w] = brute.unigram_count("▁" + w, cost, longest, tokencount.BYTE_COST)
        return known[w]

    data = [r for r in rows if r[1] is None or len(r[1]) < 4000] + ODD
    want = sorted(((d, len(brute.words(t)), sum(map(count, brute.words(t)))) for d, t in data), key=repr)
    assert tuples(tokencount.token_counts(make(data), path), "doc_id", "n_words", "n_tokens") == want
    assert tokencount.token_counts(empty, path).count() == 0


def test_terminal_table_that_starts_anew(make, rows, monkeypatch):
    path = q_tokencount.model_path()
    model = tokencount.Unigram(path)
    w = sorted({"▁" + x for _, t in rows[:40] for x in brute.words(t)})
    assert model.counts(w) == [model.counts([x])[0] for x in w]


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_groups(make, rows, empty, n, percent):
    data = rows + ODD
    got = tuples(neardup.groups(make(data), neardup.Similar(n, percent)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_groups(data, n, percent), key=repr)
    assert neardup.groups(empty, neardup.Similar(n, percent)).count() == 0


def test_last_round_of_near_groups_loses_no_link(make, rows, monkeypatch):
    """Without the centre rounds every link must come from the bounded last round."""
    monkeypatch.setattr(neardup, "centre_pairs", lambda m, i: m.selectExpr("node a", "node b").limit(0))
    got = tuples(neardup.groups(make(rows), neardup.Similar(3, 85)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_groups(rows, 3, 85), key=repr)


def test_last_round_of_near_groups_with_repeated_rows(make, monkeypatch):
    """B is over the threshold to A, whose row is repeated; all their common shingles stand in more than RARE nodes."""
    monkeypatch.setattr(neardup, "centre_pairs", lambda m, i: m.selectExpr("node a", "node b").limit(0))
    base = [f"w{i}" for i in range(100)]
    near = [(k, " ".join([*base[:100 - k], *[f"c{k}x{j}" for j in range(k)]])) for k in range(0, 14)]
    for data in (near + near[:1], near + [(None, near[0][1])] * 3 + near[5:8] * 2):
        got = tuples(neardup.groups(make(data), neardup.Similar(3, 85)), "doc_id", "n_shingles", "component_id", "kept")
        assert got == sorted(brute.near_groups(data, 3, 85), key=repr)


def test_repeated_rows_give_one_text_per_node(make, rows):
    data = make(rows + rows[:60] * 2 + [(None, rows[41][1])] * 3)
    sketched = neardup.sketches(data, neardup.Similar(3, 85)).withColumnRenamed("row_id", "node")
    first = sketched.dropDuplicates(["doc_id", "text_key"])
    texts = neardup.candidate_texts(data, first, first.select("node"))
    assert texts.count() == texts.select("node").distinct().count() == first.count()


def test_one_document_of_each_group_stays(make, rows):
    want = sorted(d for d, _, _, k in brute.near_groups(rows, 5, 80) if k)
    assert sorted(r.doc_id for r in neardup.representatives(make(rows)).collect()) == want
    assert sorted(r.doc_id for r in neardup.representatives(make(rows + rows[:50])).collect()) == want


def test_signature_is_circulant():
    c = neardup.Circulant(16)
    items = textarrays.stream(3, 50)
    pi = c.slices[:, 0]
    at = c.sigma[(items >> np.uint64(44)).astype(np.int64)]
    want = [min(int(pi[(x + k) % neardup.UNIVERSE]) for x in at) for k in range(16)]
    assert c.signature(items).tolist() == want


ITEMS = [(1, "Ka lo mi tu re sa no vi du pe ra ti ka lo"), (2, "short item"), (3, None), (4, "..."), (10, "short, ITEM!"), (5, "z")]


def test_benchmark_hits(make, rows, empty, spark):
    data = rows + ODD + [(2000, "pre ka LO mi-tu re sa no. vi du pe ra ti ka lo post short item"), (2001, "short item short item"),
                         (2002, "ka lo mi tu re sa no vi du"), (2003, "short x item z")]
    items = ITEMS + [(77, rows[0][1]), (78, rows[41][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.report(make(data), bench)
    want = [(d, n, h, i, h > 0) for d, n, h, i in brute.benchmark_hits(data, items, 10)]
    assert tuples(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == sorted(want, key=repr)
    assert sorted(((r.doc_id, r.text) for r in decontaminate.clean(make(data), bench).collect()), key=repr) == \
        sorted((row for row, w in zip(data, want) if not w[4]), key=repr)
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(make(data), bench.limit(0)).filter("contaminated").count() == 0


def test_proximity_matches(make, spark):
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id bigint, text string")
    data = [(1, "alpha beta"), (2, "alpha so beta"), (3, "alpha and then so much beta"), (4, "beta alpha"), (5, "alpha")]
    docs = make(data)
    index = decontaminate.build(docs, bench)
    near = lambda slop: sorted(r.doc_id for r in decontaminate.proximity_matches(index, slop).collect())
    assert near(0) == [1] and near(1) == [1, 2] and near(2) == [1, 2, 4] and near(4) == [1, 2, 3, 4]


def brute_proximity(text, window, slop):
    """Positions of their own for all words, by trying them all."""
    w = brute.ITEM_WORD.findall((text or "").translate(brute.LOWER))

    def fits(i, low, used):
        return i == len(window) or any(fits(i + 1, low, used | {p}) for p in range(max(0, low + i), min(len(w), low + i + slop + 1))
                                       if w[p] == window[i] and p not in used)
    return any(fits(0, low, frozenset()) for low in range(-len(window) - slop, len(w) + 1))


def test_proximity_matches_need_all_words_of_a_window(make, spark):
    rng = random.Random(7)
    items = [(1, "ka lo mi tu re sa no vi du pe"), (2, "ka lo ka mi lo ka tu re ka lo"), (3, "ti ti ti"), (4, "mi")]
    texts = [(900, "ka x x x x x x x x pe"), (901, "lo mi tu re sa no vi du"), (902, "ti ti"), (903, "ti a ti b ti"), (None, items[0][1]), (905, None)]
    for i in range(120):  # words put in, left out, replaced, exchanged
        w = rng.choice(items[:3])[1].split()
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w))
            rng.choice([lambda: w.insert(k, "zz"), lambda: w.insert(k, "ka"), lambda: w.__setitem__(k, "qq"), lambda: w.pop(k),
                        lambda: w.insert(0, w.pop(k))])()
        texts.append((i, " ".join(w)))
    texts.append((5, items[2][1]))
    index = decontaminate.build(make(texts), spark.createDataFrame(items, "item_id bigint, text string"))
    for slop in (0, 1, 3):
        got = {(r.doc_id, r.item_id) for r in decontaminate.proximity_matches(index, slop).collect()}
        want = {(d, i) for d, t in texts for i, x in items if brute_proximity(t, x.split(), slop)}
        assert got == want and {i for _, i in want} == {1, 2, 3, 4}


@pytest.mark.parametrize("n", [50, 7])
def test_substring_dedup(make, rows, empty, n):
    data = rows + ODD + [(None, rows[41][1]), (5000, rows[41][1]), (5000, rows[41][1])]
    got = tuples(substrings.deduplicated(make(data), n), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(((d, w, r, brute.sha(k)) for d, w, r, k in brute.without_repeats(data, n)), key=repr)
    assert substrings.deduplicated(empty, n).count() == 0


def test_long_documents_in_segments(monkeypatch):
    rows = corpus()
    words = np.concatenate([textarrays.word_hashes(t.encode()) for _, t in rows if t])
    whole = substrings.runs(words, np.array([0, len(words)]), 50)
    monkeypatch.setattr(substrings, "SEGMENT", 500)
    cover = lambda s, c: np.concatenate([np.arange(a, a + k) for a, k in zip(s, c)])
    got = [cover(base + r["start"], r["count"]) for base, part in substrings._segments(words, 50)
           for r in [substrings.runs(part, np.array([0, len(part)]), 50)]]
    assert np.array_equal(np.concatenate(got), cover(whole["start"], whole["count"]))


@pytest.mark.parametrize("limits", [quality.Rules(), quality.Rules(line_docs=2, line_share=0.01)])
def test_quality(make, rows, empty, limits):
    line = "all rights reserved by the very same house of print"
    data = rows + ODD + [(3000 + i, f"{line}\nown words number {i} " + "w%d " % i * (i % 4 * 5)) for i in range(12)]
    src = {i: (None if i % 7 == 0 else f"s{i % 2}") for i in range(len(data))}
    got = tuples(quality.judged(make(data, source=src.get), limits), "doc_id", "n_words", "word_chars", "n_symbols",
                 "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == sorted(brute.quality([(d, src[i], t) for i, (d, t) in enumerate(data)], limits), key=repr)
    assert quality.judged(empty, limits).count() == 0


def test_cleaned_documents_lose_the_frequent_lines(make):
    line = "all rights reserved"
    data = [(i, f"{line}\n" + " ".join(f"w{i}x{k}" for k in range(20)) + "\n  ALL  rights reserved\ntail") for i in range(5)]
    limits = quality.Rules(line_docs=2, line_share=0.01)
    out = quality.cleaned(make(data, source=lambda i: "s"), limits)
    assert out.columns == make(data).columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] == data[0][1].replace("\ntail", "\ntail")
    assert "tail" not in texts[1] and "rights" not in texts[1] and "w1x19" in texts[1]


def test_language_mixture(make, empty):
    rows = corpus()
    data = [(i, " ".join(("the of and with " if i % 2 else "der und nicht ein ") + w for w in (t or "x").split()[:30]))
            for i, (_, t) in enumerate(rows[:60])]
    docs = make(data, lang=lambda i: "en" if i % 2 else "de")
    model = langid.train(docs.select("lang", "text"))
    assert model.langs == ["de", "en"]
    odd = [(900, None), (901, ""), (902, "123 !!"), (903, "der und nicht ein " * 300 + "the of and with " * 100), (None, "the of and")]
    got = {(r.doc_id, r.text_key): r for r in langid.predict(
        make(data + odd).selectExpr("doc_id", "crc32(text) text_key", "text"), model).collect()}
    said = {k[0]: (r.lang_pred, r.score) for k, r in got.items()}
    assert all(said[i][0] == ("en" if i % 2 else "de") for i, _ in data)
    assert said[900] == said[901] == said[902] == ("und", 0.0) and said[None][0] == "en"
    assert said[903][0] == "de" and 0.7 < said[903][1] < 0.8
    nothing = langid.train(empty.select("lang", "text"))
    assert nothing.langs == [] and nothing.predict(b"words") == ("und", 0.0)


def test_packing(make, rows, empty):
    import struct

    from tokenizers import Tokenizer
    path = q_packing.tokenizer_path()
    t = Tokenizer.from_file(path)
    data = rows + ODD + [(7000, "It's the user's <|endoftext|> don't... stop!! A.B,C  ÀÉ. éa, İxİ. ½² x y 12,5"),
                         (7001, "a\x1cb \x85 c​d ñandú, ÑANDÚ; ﬁn")]
    pieces = packing.packed(make(data), path).collect()
    want = sorted(((d, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
                   for d, x in data for ids in [t.encode(x or "", add_special_tokens=False).ids + [1]]), key=repr)
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    for d, x in data:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        own = [p for p in by[d] if p.doc_tokens == len(ids)]
        for p in own:
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.start:p.start + p.length])) or d in (0, 3, None)
    assert sum(p.length for p in pieces) == sum(n for _, n, _ in want)
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length, p.tier, p.step_group))
    used = padded = 0
    for s in seqs.values():
        s.sort()
        assert [o for o, _, _, _ in s] == [sum(x[1] for x in s[:i]) for i in range(len(s))]
        n = sum(x[1] for x in s)
        assert n <= 2048 and n == s[0][2]
        used, padded = used + n, padded + (0 if n & (n - 1) == 0 else 2048 - n)
    assert padded == 0
    steps = {}
    for s in seqs.values():
        steps.setdefault((s[0][2], s[0][3]), []).append(sum(x[1] for x in s))
    assert all(sum(v) <= packing.STEP_TOKENS for (tier, _), v in steps.items())
    assert packing.packed(empty, path).count() == 0


def test_step_groups_are_full_over_several_tasks(make):
    """Three tasks of over 65536 tokens each: of each tier all groups but the last are full."""
    data = [(i, "x y " * (700 + 37 * (i % 40))) for i in range(180)]
    pieces = packing.packed(make(data), q_packing.tokenizer_path()).collect()
    tokens, windows = {}, {}
    for p in pieces:
        task = p.sequence_id >> packing.TASK_BITS
        tokens[task] = tokens.get(task, 0) + p.length
        windows[p.sequence_id] = (p.tier, p.step_group)
    assert len(tokens) == 3 and min(tokens.values()) > packing.STEP_TOKENS
    groups = {}
    for tier, group in windows.values():
        groups[tier, group] = groups.get((tier, group), 0) + tier
    for tier in {t for t, _ in groups}:
        last = max(g for t, g in groups if t == tier)
        assert all(groups.get((tier, g)) == packing.STEP_TOKENS for g in range(last))
        assert 0 < groups[tier, last] <= packing.STEP_TOKENS


PRIVATE = [
    (1, "mail bob.x@mail8.example.com now"), (2, "é@b.c a@b.c@d.e x_y@z.io_q@r.st"), (3, "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 007.0.0.255"),
    (4, "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 1" + "2" * 40), (5, "+1 (988) 555-2485 or +49 30 or + 5"), (6, "日本 a@b.cd 語"),
    (7, "a." * 3000 + "@"), (8, "1 " * 4000), (9, "x@" + "y." * 3000 + "z"), (10, "+1" * 2000), (11, "0" * 50000),
]


def test_personal_data(make, rows, empty):
    story = [(100 + i, f"{f'w{i} ' * 20} call the admiral of vetusta at admiral@fleet.example.org said vetusta {f'v{i} ' * 30}") for i in range(6)]
    other = [(200 + i, f"call the {f'plain{i} ' * 40}") for i in range(60)]
    data = rows + ODD + PRIVATE + story + other + [(100, story[0][1])]
    d = pii.Disclosure()
    want = brute.pii_spans(data, d)
    got = pii.attached(make(data), d).select("doc_id", "text", pii.joined("__base").alias("base"), pii.joined("__spans").alias("spans"))
    kinds = [k for k, _ in brute.PATTERNS] + ["term"]
    show = lambda xs: ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in xs)
    out = got.collect()
    assert len(out) == len(data)
    for r in out:
        w = want[(r.doc_id, r.text or "")]
        assert r.spans == show(w), r.doc_id
        assert r.base == show([x for x in w if x[1] < 4])
    assert any("term" in r.spans for r in out)
    assert pii.attached(empty, d).count() == 0


def terms_of(docs):
    """{doc_id: disclosing words found, with repetitions}"""
    rows = pii.attached(docs).select("doc_id", "text", "__spans").collect()
    return {r.doc_id: sorted(r.text[s["start"]:s["end"]] for s in r["__spans"] if s["kind"] == 4) for r in rows}


def test_words_that_disclose_a_part_of_entities_of_one_text_each(make):
    about = ["officer%d%d@fleet.example.org", "flagship.%d.%dx@y%d.example.net", "10.20.30.%d%d", "+1 (988) 555-248%d%d"]
    said = ["vetusta", "marineth", "gatewayo", "lineholder"]
    data = [(10 * k + i, f"q{k}{i} {said[k]} {(p % ((k, i) if p.count('%') == 2 else (k, i, i)))} plain") for k, p in enumerate(about) for i in range(4)]
    data += [(200 + i, f"plain words of nobody r{i}") for i in range(60)]
    got = terms_of(make(data))
    assert {d: w for d, w in got.items() if w} == {10 * k + i: [said[k]] for k in range(4) for i in range(4)}


def test_disclosing_words_are_found_and_spanned_in_whole_texts(make):
    far = " filler" * 40
    data = [(i, f"vetusta{far} n{i} admiral@fleet.example.org{far} Vetusta, the vetusta. vetustas") for i in range(4)]
    data += [(50, f"vetusta at sea{far}")] + [(200 + i, f"the plain words{far} r{i}") for i in range(60)]
    got = terms_of(make(data + data[:1]))
    assert {d: w for d, w in got.items() if w} == {i: ["Vetusta", "vetusta", "vetusta", "vetustas"] for i in range(4)}
    out = {r.doc_id: r.text for r in pii.sanitised(make(data)).collect()}
    assert "vetusta" not in out[0].lower().replace("[term]", "") and out[50] == data[4][1]


def test_sql_of_personal_data_on_a_table_that_holds_terms(spark, make, tmp_path):
    """Operator, brute force and SQL agree where words disclose entities and parts of them, far away and repeatedly."""
    import duckdb
    far = " filler" * 40
    data = [(i, f"vetusta{far} n{i} admiral@fleet.example.org{far} Vetusta, the vetusta. vetustas") for i in range(4)]
    data += [(20 + i, f"marineth officer{i}@fleet{i % 2}.example.org call +1 (988) 555-248{i} lineholder Lineholder") for i in range(5)]
    data += [(40 + i, f"gatewayo at 10.20.30.{i} or 10.20.31.{i}, issuero 4111 1111 1111 1111 issuero") for i in range(4)]
    data += [(60, f"vetusta gatewayo{far}"), (61, None), (62, "")] + [(200 + i, f"the plain words{far} r{i}") for i in range(60)]
    d = pii.Disclosure()
    want = brute.pii_spans(data, d)
    kinds = [k for k, _ in brute.PATTERNS] + ["term"]
    show = {i: ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in want[i, t or ""]) for i, t in data}
    assert sum("term" in x for x in show.values()) >= 10
    make(data).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in q_pii.op9_pii(spark, str(tmp_path)).collect()}
    assert {r[0]: r[6] for r in got} == show
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert set(con.execute(q_pii.SQL).fetchall()) == got


def test_sanitised_texts(make):
    data = [(1, "write to a.b@c.de or 10.0.0.1 now"), (2, None), (3, "clean")]
    out = {r.doc_id: r.text for r in pii.sanitised(make(data)).collect()}
    assert out == {1: "write to [EMAIL] or [IP] now", 2: None, 3: "clean"}


def test_components_of_chains_and_stars(spark, monkeypatch):
    """A chain in id order needs one contraction of log(length) jumps, not a round per link."""
    writes = []
    monkeypatch.setattr(neardup, "stored", lambda df, name, keep=neardup.stored: writes.append(name) or keep(df, name))
    chain = [(k, k + 1) for k in range(1000)]
    rng = random.Random(2)
    order = rng.sample(range(5000, 5200), 200)
    mixed = list(zip(order, order[1:]))
    star = [(9000, 9000 + k) for k in range(1, 50)] + [(9100, 9001)]
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(1001)}
    assert writes.count("neardup_labels") == 1 and writes.count("neardup_step") <= 15
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(mixed + star, "a bigint, b bigint")).collect()}
    assert got == {**{k: min(order) for k in order}, **{k: 9000 for k in [*range(9000, 9050), 9100]}}


def family(n, seed=3):
    """Texts of one template just under the threshold to each other, all own words shared by ten others, and two real links."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(150)]
    pool = [f"p{i}" for i in range(n * 3)]
    out = []
    for k in range(n):
        w = list(base)
        for at in rng.sample(range(5, 145, 10), 10):
            w[at] = rng.choice(pool)
        out.append((k, " ".join(w)))
    return [*out, (n, out[0][1] + " end"), (n + 1, "start " + out[7][1])]


def test_template_family_makes_few_pairs(make, monkeypatch):
    """Distinct texts below the threshold are not compared with each other, and no link is lost."""
    data, pairs = family(120), []
    keep = neardup.remaining_pairs
    monkeypatch.setattr(neardup, "remaining_pairs", lambda *a: pairs.append(keep(*a)) or pairs[-1])
    got = tuples(neardup.groups(make(data), neardup.Similar(3, 85)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_groups(data, 3, 85), key=repr)
    assert sum(p.count() for p in pairs) < 120 * 119 / 2 / 10


CLASHING = ["score", "lang_pred", "__gone", "__id", "__k", "__s", "__t", "__n", "__base", "__spans"]


def test_columns_named_like_those_of_the_operators(make, spark, rows):
    """Extra columns of any name come through stages unchanged and break no operator."""
    docs = make(rows[:60])
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("mine"))
    bench = spark.createDataFrame([(1, "no such words here")], "item_id bigint, text string")
    for out in (quality.cleaned(docs), neardup.representatives(docs), decontaminate.clean(docs, bench), pii.sanitised(docs)):
        assert out.columns == docs.columns
        assert out.count() > 0 and out.filter(" OR ".join(f"`{c}` <> 'mine'" for c in CLASHING)).count() == 0
    got = langid.predict(docs, langid.train(docs))
    assert got.columns.count("score") == got.columns.count("lang_pred") == 1 and got.count() == docs.count()


def test_mixture_by_plain_python():
    """Selection and proportions of the mixture, by dictionaries and loops."""
    rng = random.Random(6)
    alphabet = {"a": "abcde", "b": "fghij", "c": "klmno"}
    counts = np.zeros((langid.BUCKETS, 3), dtype=np.int64)
    text = lambda k, n: " ".join("".join(rng.choice(alphabet[k]) for _ in range(rng.randint(2, 6))) for _ in range(n))
    for i, k in enumerate("abc"):
        np.add.at(counts[:, i], langid.trigrams(text(k, 800).encode()), 1)
    model = langid.Model(list("abc"), counts)
    total = [int(counts[:, i].sum()) for i in range(3)]

    def plain(words):
        grams = langid.trigrams(words.encode()).tolist()
        units = [grams[i:i + langid.UNIT] for i in range(0, len(grams), langid.UNIT)]
        like = [[sum(math.log((int(counts[g, l]) + langid.ALPHA) / (total[l] + langid.ALPHA * langid.BUCKETS)) / langid.OVERLAP
                     for g in u) for l in range(3)] for u in units]

        def fit(chosen):
            pi = [1 / len(chosen)] * len(chosen)
            for _ in range(400):
                new = [0.0] * len(chosen)
                for row in like:
                    top = max(row[l] for l in chosen)
                    mass = [p * math.exp(row[l] - top) for p, l in zip(pi, chosen)]
                    for j, m in enumerate(mass):
                        new[j] += m / sum(mass) / len(like)
                pi = new
            return sum(max(row) + math.log(sum(p * math.exp(row[l] - max(row)) for p, l in zip(pi, chosen))) for row in like), pi
        chosen = [max(range(3), key=lambda l: sum(r[l] for r in like))]
        best, pi = fit(chosen)
        while len(chosen) < 3:
            (f, p), k = max(((fit(chosen + [k]), k) for k in range(3) if k not in chosen), key=lambda x: x[0][0])
            if f - best <= langid.PENALTY * math.log(len(like) + 1):
                break
            chosen, best, pi = chosen + [k], f, p
        return {"abc"[l]: p for l, p in zip(chosen, pi)}

    for parts in ("a", "b", "ab", "bc", "abc"):
        words = " ".join(text(k, 120) for k in parts)
        want, got = plain(words), model.mixture(words.encode())
        assert set(got) == set(want) == set(parts)
        assert all(abs(got[k] - want[k]) < 0.02 for k in want)
