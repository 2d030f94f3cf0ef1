"""The registered queries against their SQL at the small size, and the pipeline against brute force."""

import os
import struct
import sys
import zlib

import brute
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from check_oracle import SPARK2DUCK, digest, duck  # noqa: E402

from tidecast.llm import catalog, neardup, pii, q_packing, quality  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(catalog.oracle_sql()[name])
    want, cols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    kinds = {f.name: SPARK2DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert kinds == dict(zip(cols, [str(d[1]) for d in cur.description]))
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.queries()) == list(range(1, 14))


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = catalog.queries()["op4_language_id"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got) and len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def _brute_pipeline(docs, bench):
    """doc_id -> text of what each stage keeps, by plain Python."""
    r = quality.Rules()
    facts = brute.quality([(d, s, t) for d, s, t in docs], r)
    assert all(x[7] == (not x[6]) for x in facts), "no line of this small table is above its host's limit"
    kept = [(d, t) for (d, _, t), x in zip(docs, facts) if x[7]]
    yield dict(kept)
    s = neardup.Similar()
    kept = [(d, t) for (d, t), g in zip(kept, brute.near_groups(kept, s.shingle, s.percent)) if g[3]]
    yield dict(kept)
    kept = [(d, t) for (d, t), h in zip(kept, brute.benchmark_hits(kept, bench, 10)) if not h[2]]
    yield dict(kept)
    spans, out = brute.pii_spans(kept, pii.Disclosure()), {}
    for d, t in kept:
        new, at = [], 0
        for a, k, b in spans[(d, t)]:
            if a >= at:
                new += [t[at:a], f"[{pii.KINDS[k].upper()}]"]
            at = max(at, b)
        out[d] = "".join(new) + t[at:]
    yield out


def test_pipeline_against_brute_force(spark):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = docs.columns
    want = _brute_pipeline([(r.doc_id, r.source, r.text) for r in docs.collect()],
                           [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want):
        docs = stage(spark, docs, SF)
        assert docs.columns == cols
        assert {r.doc_id: r.text for r in docs.collect()} == expected, name
    t = Tokenizer.from_file(q_packing.tokenizer_path())
    ids = {d: t.encode(x, add_special_tokens=False).ids + [1] for d, x in expected.items()}
    got = {}
    for p in corpus_pipeline.run(spark, SF).collect():
        assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.doc_id][p.start:p.start + p.length]))
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == {d: len(x) for d, x in ids.items()}


def test_stages_take_odd_and_empty_tables(spark, make, empty):
    odd = make([(1, None), (1, None), (None, ""), (None, "a b"), (2, "x " * 50), (3, "ab " + "word %d " * 30 % tuple(range(30)))])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 0
        assert stage(spark, empty, SF).count() == 0
