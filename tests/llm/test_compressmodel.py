"""The compression classifier against plain compression of whole texts and on held-out labels."""

import random
import zlib

import numpy as np
import pytest
import zstandard
from samples import sentence

from tidecast.llm import compressmodel, q_compressmodel

LABELS = "doc_id bigint, quality int, toxic int, text string, score double"


def labelled(make, spark, n=240, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = sentence(rng, rng.randint(20, 200)).split()
        rows.append((k, " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)))
        labels.append((k, 0 if bad else 1, 0, "x", 0.5))
    return rows, make(rows), spark.createDataFrame(labels, LABELS)


def by_hand(text, model):
    """The score of one text, compressed block by block without the operator's helpers."""
    s, sizes = model.settings, []
    for d in (zstandard.ZstdCompressionDict(model.bad), zstandard.ZstdCompressionDict(model.good), None):
        c = zstandard.ZstdCompressor(level=s.level, dict_data=d, write_checksum=False,
                                     write_content_size=False, write_dict_id=False)
        sizes.append(sum(len(c.compress(text[k:k + s.block])) for k in range(0, len(text), s.block)))
    z = model.curve[0] * (sizes[0] - sizes[1]) / len(text) + model.curve[1] * sizes[2] / len(text) + model.curve[2]
    return 1 / (1 + np.exp(-z))


def test_scores_by_hand_and_separation(make, spark):
    rows, docs, labels = labelled(make, spark)
    model = compressmodel.train(docs, labels)
    got = {r.doc_id: r.score for r in compressmodel.scored(docs, model).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        assert abs(got[d] - by_hand(t.encode(), model)) < 1e-9
    assert sum((got[d] >= 0.3) == (d % 4 != 0) for d, _ in rows) == len(rows)
    again = compressmodel.train(docs.repartition(5), labels.repartition(4))
    assert again.good == model.good and again.bad == model.bad and np.allclose(again.curve, model.curve)


def test_long_texts_are_scored_whole(make, spark):
    rows, docs, labels = labelled(make, spark)
    model = compressmodel.train(docs, labels)
    rng = random.Random(9)
    clean = sentence(rng, 5000)
    tail = " ".join(w.upper() + "!!" for w in sentence(rng, 30000).split())
    got = {r.doc_id: r.score for r in compressmodel.scored(make([(1, clean), (2, clean + " " + tail)]), model).collect()}
    assert got[1] > 0.5 > got[2] and abs(got[2] - by_hand((clean + " " + tail).encode(), model)) < 1e-9


def test_copies_do_not_fill_the_sample(make, spark):
    rows, _, labels = labelled(make, spark)
    many = rows + [(1, rows[1][1])] * 300
    s = compressmodel.Settings(sample_blocks=20, block=256)
    a, b = compressmodel.train(make(rows), labels, s), compressmodel.train(make(many), labels, s)
    assert a.good == b.good and a.bad == b.bad


@pytest.mark.parametrize("kind", ["no labels", "one label", "odd labels", "no documents", "few"])
def test_odd_training_tables(make, spark, empty, rows, kind):
    docs = empty if kind == "no documents" else make(rows)
    labels = {"no labels": [], "one label": [(3, 1, 0, "", 0.0), (6, 1, 0, "", 0.0)],
              "odd labels": [(None, 1, 0, "", 0.0), (3, None, 0, "", 0.0), (6, 7, 0, "", 0.0)],
              "few": [(3, 1, 0, "", 0.0), (6, 0, 0, "", 0.0), (6, 1, 0, "", 0.0)]}.get(kind, [(3, 1, 0, "", 0.0), (6, 0, 0, "", 0.0)])
    model = compressmodel.train(docs, spark.createDataFrame(labels, LABELS))
    got = compressmodel.scored(make(rows + [(None, "x y"), (None, None)]), model).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    if kind in ("no labels", "odd labels"):
        assert {r.score for r in got} == {0.5}
    if kind == "one label":
        assert {r.score for r in got} == {0.75}
    assert compressmodel.scored(empty, model).count() == 0


def test_empty_texts_get_the_share(make, spark):
    _, docs, labels = labelled(make, spark)
    model = compressmodel.train(docs, labels)
    got = [r.score for r in compressmodel.scored(make([(1, None), (2, ""), (2, "")]), model).collect()]
    assert got == [model.share] * 3 and abs(model.share - 181 / 242) < 1e-12


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in q_compressmodel.op12_quality_classifier(spark, sf).collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.94 * len(held)
    assert all(p == 1 for p, q in held if q == 1)
