"""Forecast models over the whole window arrays (30 x 20 past, 7 x 18 future inputs).

* ``fit_ridge``: one pass over the time blocks. Each task adds up the products of its
  windows' inputs and targets; the blocks are merged by row over a second, small shuffle and
  the normal equations, (inputs + 1) squared numbers whatever the data, are solved on the driver.
  No window is written or shuffled.
* ``fit_network``: rounds of one epoch per task from common weights and averaging by
  windows (a network with one hidden layer). The validation windows, the last fifth of the training ones of each
  series, are scored with the averaged weights; after ``patience`` rounds without a better
  loss the fit stops and the best weights come back.
* ``save`` / ``load``: a model is a Parquet table of its arrays.
* ``score``: ``predict_batch_udf`` with two input tensors and an array result; the model file
  is sent to each executor once (``addFile``) and loaded once per Python worker.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks as bl
from .workers import arrow_map, ship


@dataclass(frozen=True)
class ArrayModel:
    """kind "linear" (w: inputs + 1 x horizon) or "network" (w1, b1, w2, b2), past inputs first,
    in time order and per time in feature order."""
    kind: str
    arrays: dict[str, np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """``x``: rows of inputs, the last one 1."""
        a = self.arrays
        if self.kind == "linear":
            return x @ a["w"]
        return np.tanh(x[:, :-1] @ a["w1"] + a["b1"]) @ a["w2"] + a["b2"]


# ---- one-pass ridge ----------------------------------------------------------------------------

def gram(blocks: DataFrame, lay: bl.Layout, split: str = "train") -> tuple[np.ndarray, np.ndarray, int]:
    """(X'X, X'Y, windows) over the windows of a split; X has a last column of ones."""
    def partial(batches):
        total = None
        for b in batches:
            for w in bl.each_block(b, lay):
                at = w.of(split)
                x = w.inputs[at]
                xy = x.T @ np.concatenate([x, w.y[at]], axis=1)
                total = xy if total is None else total + xy
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), b.column("v")):
                v = v.values.to_numpy()
                total[i] = v if i not in total else total[i] + v
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["i", "v"])

    rows = arrow_map(arrow_map(blocks, partial, "i int, v array<double>").repartition("i"), merge, "i int, v array<double>").collect()
    if not rows:
        raise ValueError("no window to fit")
    m = np.array([r.v for r in sorted(rows, key=lambda r: r.i)])
    p = len(m)
    return m[:, :p], m[:, p:], int(round(m[p - 1, p - 1]))


def solve_ridge(xx: np.ndarray, xy: np.ndarray, n: int, reg: float, inputs: list[int] | None = None) -> ArrayModel:
    """Weights that minimise mean squared error + ``reg`` |w|^2 (the constant is free); ``inputs``:
    use these inputs only, all other weights are 0."""
    p = len(xx) - 1
    use = [*(range(p) if inputs is None else inputs), p]
    a = xx[np.ix_(use, use)] / n + np.diag([reg] * (len(use) - 1) + [0.0])
    w = np.zeros((p + 1, xy.shape[1]))
    w[use] = np.linalg.lstsq(a, xy[use] / n, rcond=None)[0]
    return ArrayModel("linear", {"w": w})


def fit_ridge(blocks: DataFrame, lay: bl.Layout, reg: float = 1e-3) -> ArrayModel:
    return solve_ridge(*gram(blocks, lay), reg)


# ---- network with a validation monitor -----------------------------------------------------------

@dataclass
class Fit:
    """A finished fit: the best weights, their round and validation loss, and all losses."""
    model: ArrayModel
    best_round: int
    best_loss: float
    losses: list[float] = field(default_factory=list)
    stopped_early: bool = False


def _initial(inputs: int, hidden: int, outputs: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {"w1": rng.normal(0, 1 / np.sqrt(inputs), (inputs, hidden)), "b1": np.zeros(hidden),
            "w2": rng.normal(0, 0.1 / np.sqrt(hidden), (hidden, outputs)), "b2": np.zeros(outputs)}


def _flat(a: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([a[k].ravel() for k in ("w1", "b1", "w2", "b2")])


def _unflat(v: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in ("w1", "b1", "w2", "b2"):
        out[k] = v[at:at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def gradient(a: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean squared error of a batch."""
    h = np.tanh(x @ a["w1"] + a["b1"])
    d = 2 * (h @ a["w2"] + a["b2"] - y) / y.size
    dh = (d @ a["w2"].T) * (1 - h * h)
    return {"w1": x.T @ dh, "b1": dh.sum(0), "w2": h.T @ d, "b2": d.sum(0)}


def _epoch(a: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, moment, rate: float, batch: int):
    """One pass of Adam steps over the rows in order; ``moment`` carries over blocks."""
    for at in range(0, len(x), batch):
        g = gradient(a, x[at:at + batch], y[at:at + batch])
        moment["t"] += 1
        for k, v in g.items():
            m, s = moment.setdefault(k, [np.zeros_like(v), np.zeros_like(v)])
            m[:] = 0.9 * m + 0.1 * v
            s[:] = 0.999 * s + 0.001 * v * v
            a[k] = a[k] - rate * (m / (1 - 0.9 ** moment["t"])) / (np.sqrt(s / (1 - 0.999 ** moment["t"])) + 1e-8)
    return a


def fit_network(blocks: DataFrame, lay: bl.Layout, hidden: int = 16, max_rounds: int = 30, patience: int = 3,
                rate: float = 1e-3, batch: int = 64, seed: int = 7, label=None) -> Fit:
    """``label``: a function from ``Windows`` to targets (n x horizon), else their ``y``.
    Every round reads the stored blocks once; the same blocks in the same partitions give the same fit."""
    label = label or (lambda w: w.y)
    inputs = lay.wp.lookback * len(lay.past) + lay.wp.horizon * len(lay.future)
    now = _initial(inputs, hidden, lay.wp.horizon, seed)
    best, done = None, None

    def round_of(weights: dict[str, np.ndarray], learn: bool):
        def run(batches):
            a, moment, n, loss, n_val = {k: v.copy() for k, v in weights.items()}, {"t": 0}, 0, 0.0, 0
            start = ArrayModel("network", weights)
            for b in batches:
                for w in bl.each_block(b, lay):
                    x, y, fit, val = w.inputs, label(w), w.of("fit"), w.of("val")
                    loss += float(((start.predict(x[val]) - y[val]) ** 2).sum())
                    n_val += len(y[val])
                    if learn:
                        a = _epoch(a, x[fit, :-1], y[fit], moment, rate, batch)
                    n += len(y[fit])
            if n or n_val:
                v = _flat(a) * n
                at = np.arange(len(v) + 3)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.concatenate([v, [n, loss, n_val]]))], ["i", "v"])
        rows = arrow_map(blocks, run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        if not rows:
            raise ValueError("no window to fit")
        total = np.array([r.v for r in rows])
        n, loss, n_val = total[-3:]
        return _unflat(total[:-3] / max(n, 1), now), float(loss / max(n_val * lay.wp.horizon, 1))

    losses = []
    for k in range(max_rounds + 1):
        new, loss = round_of(now, k < max_rounds)    # the loss of the weights that came in, and the next weights
        losses.append(loss)
        if best is None or loss < best[1]:
            best = (k, loss, now)
        elif k - best[0] >= patience:
            done = True
            break
        now = new
    return Fit(ArrayModel("network", best[2]), best[0], best[1], losses, bool(done))


# ---- kept models ------------------------------------------------------------------------------------

def save(spark: SparkSession, model: ArrayModel, path: str) -> str:
    """Write the model as a Parquet table (name, shape, values) under ``path`` (new)."""
    rows = [(f"{model.kind}/{k}", [int(n) for n in v.shape], [float(x) for x in v.ravel()]) for k, v in model.arrays.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values array<double>").coalesce(1).write.parquet(path)
    return path


def load(spark: SparkSession, path: str) -> ArrayModel:
    rows = spark.read.parquet(path).collect()
    arrays = {r.name.split("/")[1]: np.array(r["values"]).reshape(r["shape"]) for r in rows}
    return ArrayModel(rows[0].name.split("/")[0], arrays)


def _sent(spark: SparkSession, model: ArrayModel) -> str:
    """Send the model to every executor once; the name under which workers find it."""
    name = f"tidecast-model-{uuid.uuid4().hex[:12]}.npz"
    path = os.path.join(tempfile.mkdtemp(prefix="tidecast-model-"), name)
    np.savez(path, kind=model.kind, **model.arrays)
    spark.sparkContext.addFile(path)
    return name


def score(windows: DataFrame, model: ArrayModel, lay: bl.Layout, past: str = "past", future: str = "future",
          out: str = "scaled_prediction", batch_size: int = 512) -> DataFrame:
    """Adds the horizon's predictions (array, scale of the label). ``past`` and ``future``: one array per
    feature, as ``blocks.cut_windows`` gives them."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType
    spark = windows.sparkSession
    ship(spark)
    name, lookback, horizon, n_past, n_future = _sent(spark, model), lay.wp.lookback, lay.wp.horizon, len(lay.past), len(lay.future)

    def make():
        from pyspark import SparkFiles
        z = np.load(SparkFiles.get(name))
        loaded = ArrayModel(str(z["kind"]), {k: z[k] for k in z.files if k != "kind"})

        def predict(p, f):
            n = len(p)
            x = np.concatenate([p.transpose(0, 2, 1).reshape(n, -1), f.transpose(0, 2, 1).reshape(n, -1), np.ones((n, 1))], axis=1)
            return loaded.predict(x)
        return predict

    udf = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch_size,
                            input_tensor_shapes=[[n_past, lookback], [n_future, horizon]])
    return windows.withColumn(out, udf(F.flatten(past), F.flatten(future)))


def in_units(scaled: str | Column, target: str) -> Column:
    """Predictions of the scaled target back in units, never negative (needs the block's scaler columns)."""
    return F.transform(scaled, lambda z: F.greatest(z * F.col(f"range_{target}") + F.col(f"lo_{target}"), F.lit(0.0)))


# ---- test error of a model and of the naive baselines -------------------------------------------------

def errors(blocks: DataFrame, lay: bl.Layout, predict, split: str = "test") -> DataFrame:
    """One row: points, and the mean absolute error of the model, of the last value and of the
    same weekday a week before. ``predict``: from ``Windows`` to units (n x horizon). The raw target must be in the blocks."""
    actual = f"raw_{lay.target}"

    def run(w: bl.Windows) -> pa.RecordBatch:
        at = w.of(split)
        y, behind = w.ahead(actual)[at], w.behind(actual)[at]
        ways = [predict(w)[at] if y.size else y, np.repeat(behind[:, -1:], lay.wp.horizon, axis=1), behind[:, -lay.wp.horizon:]]
        return pa.RecordBatch.from_arrays([pa.array([y.size]), *(pa.array([float(np.abs(y - p).sum())]) for p in ways)],
                                          ["n", "model", "last_value", "weekly_seasonal"])
    parts = bl.map_windows(blocks, lay, run, "n bigint, model double, last_value double, weekly_seasonal double")
    return parts.agg(F.sum("n").alias("n_points"), *[(F.sum(c) / F.sum("n")).alias(c) for c in ("model", "last_value", "weekly_seasonal")])
