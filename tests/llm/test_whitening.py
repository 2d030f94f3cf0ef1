"""Whitening against numpy on whole matrices, odd rows included."""

from collections import defaultdict

import numpy as np
import pytest

from tidecast.llm import q_whitening, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x array<bigint>, w bigint, key string, part int, z double, parts int"
CLASH = (1, [1], 2, "k", 3, 0.5, 4)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *CLASH) for i, v in rows], SCHEMA).repartition(3)


def expected(vectors, weights=None):
    x = np.floor(1024 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 100000
    w = np.ones(len(x), dtype=np.int64) if weights is None else weights
    n, s = int(w.sum()), (x * w[:, None]).sum(axis=0)
    dev = [sum(int(a) ** 2 for a in n * row - s) for row in x]
    c = x - s / n
    v = (c * w[:, None]).T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(8, int((e > 1e-12 * e[0]).sum()))
    return n, dev, c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v)


def compare(df, ids, vectors):
    n, dev, z, share = expected(vectors)
    rows, per = df.collect(), defaultdict(list)
    assert len(rows) == z.size
    sign = np.ones(z.shape[1])
    for r in rows:
        per[r.vec_id, r.component].append(r)
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained - share[r.component - 1]) < 1e-9 * share[r.component - 1]
    for k in range(z.shape[1]):
        big = int(np.argmax(np.abs(z[:, k])))
        sign[k] = np.sign(per[ids[big], k + 1][0].whitened * z[big, k])
    left = {key: [r.whitened for r in rs] for key, rs in per.items()}
    for i, d, row in zip(ids, dev, z):
        for k, value in enumerate(row * sign):
            near = min(left[i, k + 1], key=lambda x: abs(x - value))
            assert abs(near - value) < 1e-7 * max(1, abs(value))
            left[i, k + 1].remove(near)
            assert d in {r.deviation for r in per[i, k + 1]}


def vectors(n=300, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) * np.linspace(0.05, 1, dim)).astype(np.float32)


def test_query_matches_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    df = q_whitening.op13_embedding_whitening(spark, sf)
    assert dict(df.dtypes)["deviation"] == "bigint" and dict(df.dtypes)["component"] == "int"
    compare(df, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_repeated_hot_and_odd_rows(spark):
    v = vectors()
    ids, data = list(range(300)), [x.tolist() for x in v]
    ids += list(range(1000, 1400)) + [None, None, 7]                  # one vector in over half of the rows
    data += [data[0]] * 402 + [data[3]]
    odd = [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [float("nan")] + data[0][1:]), (2004, [float("inf")] + data[0][1:]),
           (2005, [None] + data[0][1:]), (2006, [1e30] + data[0][1:]), (2007, data[0] + [1.0])]
    compare(whitening.whitened(frame(spark, [*zip(ids, data), *odd])), ids, data)


def test_weights_one_fits_distinct_vectors(spark):
    data = [x.tolist() for x in vectors(60)]
    out = whitening.whitened(frame(spark, list(enumerate(data)) + [(900 + k, data[0]) for k in range(50)]), weights="one").collect()
    assert {r.n for r in out} == {60} and len(out) == 110 * 8
    with pytest.raises(ValueError):
        whitening.whitened(frame(spark, []), weights="other")


def test_degenerate_tables(spark):
    one = [0.25, -0.5, 0.125]
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, one)])).count() == 0
    assert whitening.whitened(frame(spark, [(k, one) for k in range(5)])).count() == 0
    assert whitening.whitened(frame(spark, [(1, []), (2, None)])).count() == 0
    flat = [[float(k), 2.0 * k, 1.0] for k in range(5)]               # one direction only
    out = whitening.whitened(frame(spark, list(enumerate(flat)))).collect()
    assert len(out) == 5 and {r.component for r in out} == {1} and all(abs(r.explained - 1) < 1e-12 for r in out)


def test_deviation_stays_exact_beyond_64_bits():
    n, x = 3 * 10 ** 9, np.array([[100512, 99000], [100000, 100001]])
    sums = [int(n * 100000.4), int(n * 100000.2)]
    v = whitening._scaled(x, n, sums)
    exact = [[n * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert v.tolist() == exact
    e = whitening._exact(v, 2 * int(np.abs(v).max()) ** 2)
    assert (e * e).sum(axis=1).tolist() == [sum(a * a for a in row) for row in exact]
