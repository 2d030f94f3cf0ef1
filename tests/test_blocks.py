"""Time blocks and the models on them."""

import os

import numpy as np
import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from tidecast.operators import arraymodels as am
from tidecast.operators import blocks as bl
from tidecast.operators import windows
from tidecast.params import WindowParams
from tidecast.plans import q_models, tables
from tidecast.session import scratch_path

LAY = bl.Layout(("a", "b"), ("b",), "a", raw=("a",), scalers=("a",), key="k", order="t", wp=WindowParams(lookback=5, horizon=2), size=4)


def series(spark, sizes, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(k, t, float(rng.integers(0, 50)), float(t % 7)) for k, n in enumerate(sizes) for t in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, a double, b double")
    return rows, windows.with_positions(df, "k", "t")


def test_windows_of_blocks_are_the_windows_of_the_series(spark):
    sizes = [30, 7, 6, 8, 9, 1, 23]                                # shorter than a window, one window, block edges
    rows, df = series(spark, sizes)
    blocks = bl.time_blocks(df, LAY).cache()
    got = {(r.k, r.sample_index): r for r in bl.cut_windows(blocks, LAY).collect()}
    want = 0
    for k, n in enumerate(sizes):
        z = np.array([r[2:] for r in rows if r[0] == k])
        width = np.where(np.ptp(z, axis=0) == 0, 1, np.ptp(z, axis=0))
        s = (z - z.min(axis=0)) / width
        n_windows = max(n - 7 + 1, 0) if n >= 8 else max(n - 5 - 2 + 1, 0)
        for i in range(n_windows):
            r = got[k, i]
            assert np.allclose(r.past, s[i:i + 5].T) and np.allclose(r.future, [s[i + 5:i + 7, 1]]) and np.allclose(r.y, s[i + 5:i + 7, 0])
            assert r.a == z[i + 5:i + 7, 0].tolist() and r.anchor_date == i + 4
            assert r.split == ("test" if i >= int(n_windows * 0.8) else "train")
            want += 1
    assert len(got) == want
    # no window is cut in two, rows beyond block and halo are not stored
    assert all(len(r.z_a) <= LAY.size + LAY.halo for r in blocks.collect())

    def digest(w):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays([pa.array([w.row["k"]] * w.n, pa.int32()), pa.array(w.index.astype(np.int32)),
                                           pa.array(w.past[:, :, 0].tolist()), pa.array(w.ahead("raw_a").tolist())], ["k", "i", "p", "r"])
    views = bl.map_windows(blocks, LAY, digest, "k int, i int, p array<double>, r array<double>").collect()
    assert {(r.k, r.i): (r.p, r.r) for r in views} == {key: (r.past[0], r.a) for key, r in got.items()}
    blocks.unpersist()


def _bytes(path):
    root = path.replace("file:", "")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_blocks_store_every_row_about_once(spark):
    feat = tables.feature_table(spark, SF_SMALL)
    lay = q_models.PANEL
    blocks = bl.time_blocks(feat, lay)
    n = feat.count()
    held = blocks.agg(F.sum(F.size("at"))).first()[0]
    assert held <= n * (lay.size + lay.halo) / lay.size * 1.05
    a, b = scratch_path(spark, "feat"), scratch_path(spark, "blocks")
    scaled = feat.select("Store", "Date", *[F.col(c).cast("double") for c in lay.scaled])
    scaled.coalesce(1).write.option("parquet.enable.dictionary", "false").parquet(a)
    blocks.select("Store", "block", "at", *[f"z_{c}" for c in lay.scaled]).coalesce(1).write.option("parquet.enable.dictionary", "false").parquet(b)
    assert _bytes(b) <= 1.5 * _bytes(a)


def test_building_blocks_adds_no_shuffle(spark):
    feat = tables.feature_table(spark, SF_SMALL)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count(bl.time_blocks(feat, q_models.PANEL)) == count(feat)


def test_ridge_equals_least_squares_on_all_windows(spark):
    _, df = series(spark, [60, 45, 8])
    blocks = bl.time_blocks(df, LAY)
    xx, xy, n = am.gram(blocks.repartition(4), LAY)
    x, y = [], []
    for r in bl.cut_windows(blocks, LAY).filter("split = 'train'").collect():
        x.append([*np.array(r.past).T.ravel(), *np.array(r.future).T.ravel(), 1.0])
        y.append(r.y)
    x, y = np.array(x), np.array(y)
    assert n == len(x) and np.allclose(xx, x.T @ x) and np.allclose(xy, x.T @ y)
    reg = 0.01
    pen = np.diag([reg] * (x.shape[1] - 1) + [0.0])
    w = np.linalg.solve(x.T @ x / n + pen, x.T @ y / n)
    assert np.allclose(am.fit_ridge(blocks, LAY, reg).arrays["w"], w, atol=1e-8)


def test_saved_model_scores_the_same_in_batches(spark):
    _, df = series(spark, [40, 30])
    blocks = bl.time_blocks(df, LAY)
    rng = np.random.default_rng(0)
    inputs = LAY.wp.lookback * 2 + LAY.wp.horizon
    for model in (am.ArrayModel("linear", {"w": rng.normal(size=(inputs + 1, 2))}),
                  am.ArrayModel("network", am._initial(inputs, 3, 2, seed=1))):
        kept = am.load(spark, am.save(spark, model, scratch_path(spark, "model")))
        assert kept.kind == model.kind and all(np.array_equal(kept.arrays[k], v) for k, v in model.arrays.items())
        w = bl.cut_windows(blocks, LAY)
        for r in am.score(w, kept, LAY, batch_size=7).collect():
            x = np.array([*np.array(r.past).T.ravel(), *np.array(r.future).T.ravel(), 1.0])
            assert np.allclose(r.scaled_prediction, model.predict(x[None])[0])


def test_network_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    a, x, y = am._initial(6, 4, 2, 5), rng.normal(size=(9, 6)), rng.normal(size=(9, 2))
    g = am.gradient(a, x, y)

    def loss(a):
        return float(((np.tanh(x @ a["w1"] + a["b1"]) @ a["w2"] + a["b2"] - y) ** 2).mean())
    for k, at in (("w1", (2, 1)), ("b1", (3,)), ("w2", (0, 1)), ("b2", (1,))):
        up, down = ({n: v.copy() for n, v in a.items()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        assert abs((loss(up) - loss(down)) / 2e-6 - g[k][at]) < 1e-6


def test_network_stops_and_restores_the_best_weights(spark):
    """Learnable series: the loss falls; a huge rate spoils it: the fit stops early with the weights of the best round."""
    _, df = series(spark, [120, 90])
    blocks = bl.time_blocks(df, LAY).repartition(3, "k", "block").cache()
    label = lambda w: w.past[:, -1, 1:2] * np.ones((1, 2))  # noqa: E731  known from the inputs
    fit = am.fit_network(blocks, LAY, hidden=4, max_rounds=6, patience=6, rate=0.01, batch=8, label=label)
    assert fit.losses[-1] < 0.5 * fit.losses[0] and not fit.stopped_early
    bad = am.fit_network(blocks, LAY, hidden=4, max_rounds=30, patience=2, rate=8.0, batch=8, label=label)
    assert bad.stopped_early and len(bad.losses) == bad.best_round + 3 and bad.best_loss == min(bad.losses)
    want = am.fit_network(blocks, LAY, hidden=4, max_rounds=max(bad.best_round, 1), patience=99, rate=8.0, batch=8, label=label)
    assert bad.best_round == 0 or np.allclose(want.losses[:bad.best_round + 1], bad.losses[:bad.best_round + 1])
    blocks.unpersist()


def test_fit_without_windows(spark):
    _, df = series(spark, [3, 2])
    with pytest.raises(ValueError):
        am.gram(bl.time_blocks(df, LAY), LAY)
