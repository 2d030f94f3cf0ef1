"""Time blocks with halo: the arrays of all sliding windows, stored once.

A series is cut into blocks of ``size`` window starts. A block row holds, per column, the
values of its rows and of the ``lookback + horizon - 1`` rows after them (the halo), so every
window that starts in the block lies whole within it: the stored table is
(size + halo) / size of the feature table, where one array row per window would be its
37-fold. Windows are cut on read, either as Spark arrays (``cut_windows``) or as numpy
views over a batch of blocks (``map_windows``), which copies nothing per window.

Values are min-max scaled per series over all its rows. Fit, scaling and grouping use
the one partitioning of the series, so building the blocks adds no shuffle to the feature table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scaling as sc
from ..params import WindowParams
from .windows import _counts, split_label
from .workers import arrow_map

SIZE = 256


@dataclass(frozen=True)
class Layout:
    """What the blocks hold: streams of scaled columns, the scaled target, raw columns
    ``raw`` and the scaler (lo, range) of ``scalers``; ``residual``: a column whose standard-scaled
    values are the label instead of the target's."""
    past: tuple[str, ...]
    future: tuple[str, ...]
    target: str = "Sales"
    raw: tuple[str, ...] = ()
    scalers: tuple[str, ...] = ()
    residual: str | None = None
    key: str = "Store"
    order: str = "Date"
    wp: WindowParams = WindowParams()
    size: int = SIZE

    @property
    def scaled(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.past, *self.future, self.target]))

    @property
    def halo(self) -> int:
        return self.wp.lookback + self.wp.horizon - 1

    @property
    def label(self) -> str:
        return "z_label" if self.residual else f"z_{self.target}"


def time_blocks(feat: DataFrame, lay: Layout) -> DataFrame:
    """(key, block, first, n_windows, train_size, fit_size, one array per column, scalers)."""
    whole = Window.partitionBy(lay.key)

    def lo_hi(c):
        x = F.col(c).cast("double")
        return F.min(x).over(whole), F.max(x).over(whole)
    bounds = {c: lo_hi(c) for c in dict.fromkeys([*lay.scaled, *lay.scalers])}
    values = [sc.minmax_transform(F.col(c).cast("double"), *bounds[c]).alias(f"z_{c}") for c in lay.scaled]
    values += [F.col(c).cast("double").alias(f"raw_{c}") for c in lay.raw]
    if lay.residual:
        values.append(sc.standard_transform(F.col(lay.residual), F.avg(lay.residual).over(whole),
                                            F.stddev_pop(lay.residual).over(whole)).alias("z_label"))
    names = [f"z_{c}" for c in lay.scaled] + [f"raw_{c}" for c in lay.raw] + (["z_label"] if lay.residual else [])
    fitted = [x.alias(n) for c in lay.scalers for x, n in (
        (bounds[c][0], f"lo_{c}"), (sc.safe_range(*bounds[c]), f"range_{c}"))]
    z = feat.select(lay.key, lay.order, "row_position", "n_rows", *values, *fitted)

    own = F.floor(F.col("row_position") / lay.size).cast("int")
    before = F.floor((F.col("row_position") - lay.halo) / lay.size).cast("int")     # first block whose halo reaches this row
    rows = z.withColumn("block", F.explode(F.sequence(F.greatest(before, F.lit(0)), own)))
    windows = _counts(F.col("n_rows"), lay.wp)
    rows = rows.filter(F.col("block") * lay.size < windows["n_windows"])
    constant = ["n_rows", *[f"{p}_{c}" for c in lay.scalers for p in ("lo", "range")]]
    out = rows.groupBy(lay.key, "block").agg(
        F.sort_array(F.collect_list(F.struct("row_position", F.col(lay.order).alias("at"), *names))).alias("r"),
        *[F.first(c).alias(c) for c in constant])
    return out.select(lay.key, "block", (F.col("block") * lay.size).alias("first"), *[v.alias(n) for n, v in windows.items()],
                      F.col("r")["at"].alias("at"), *[F.col("r")[n].alias(n) for n in names], *constant[1:])


def starts(lay: Layout) -> Column:
    """Offsets of the windows that start in a block."""
    return F.sequence(F.lit(0), F.least(F.lit(lay.size), F.col("n_windows") - F.col("first")) - 1)


def past_slice(name: str, lay: Layout) -> Column:
    """The lookback values of an array column for the window at ``offset``."""
    return F.slice(name, F.col("offset") + 1, lay.wp.lookback)


def ahead_slice(name: str, lay: Layout) -> Column:
    return F.slice(name, F.col("offset") + 1 + lay.wp.lookback, lay.wp.horizon)


def cut_windows(blocks: DataFrame, lay: Layout) -> DataFrame:
    """One row per window: key, sample_index, anchor_date, ``past`` and ``future`` (one array per
    feature), ``y``, every raw column's horizon values and the split."""
    w = blocks.select("*", F.explode(starts(lay)).alias("offset"))
    index = (F.col("first") + F.col("offset")).cast("int")
    return w.select(
        lay.key, index.alias("sample_index"), F.element_at("at", F.col("offset") + lay.wp.lookback).alias("anchor_date"),
        F.array(*[past_slice(f"z_{c}", lay) for c in lay.past]).alias("past"),
        F.array(*[ahead_slice(f"z_{c}", lay) for c in lay.future]).alias("future"), ahead_slice(lay.label, lay).alias("y"),
        *[ahead_slice(f"raw_{c}", lay).alias(c) for c in lay.raw], split_label(index, F.col("train_size")).alias("split"))


class Windows:
    """The windows of one block as numpy views: ``past`` (n, lookback, features), ``future``
    (n, horizon, features), ``y`` (n, horizon), raw columns by ``ahead`` and ``behind``."""

    def __init__(self, row: dict, lay: Layout):
        self.row, self.lay, self.first = row, lay, row["first"]
        self.n = min(lay.size, row["n_windows"] - self.first)
        self.index = np.arange(self.first, self.first + self.n)

    def _views(self, names: list[str], skip: int, length: int) -> np.ndarray:
        z = np.stack([self.row[n] for n in names]) if names else np.zeros((0, len(self.row[self.lay.label])))
        return sliding_window_view(z[:, skip:], length, axis=1)[:, :self.n].transpose(1, 2, 0)

    @property
    def past(self) -> np.ndarray:
        return self._views([f"z_{c}" for c in self.lay.past], 0, self.lay.wp.lookback)

    @property
    def future(self) -> np.ndarray:
        return self._views([f"z_{c}" for c in self.lay.future], self.lay.wp.lookback, self.lay.wp.horizon)

    def ahead(self, name: str) -> np.ndarray:
        return self._views([name], self.lay.wp.lookback, self.lay.wp.horizon)[:, :, 0]

    def behind(self, name: str) -> np.ndarray:
        return self._views([name], 0, self.lay.wp.lookback)[:, :, 0]

    @property
    def y(self) -> np.ndarray:
        return self.ahead(self.lay.label)

    @property
    def inputs(self) -> np.ndarray:
        """All past, then all future values of every window as one row, and a one."""
        return np.concatenate([self.past.reshape(self.n, -1), self.future.reshape(self.n, -1), np.ones((self.n, 1))], axis=1)

    def of(self, split: str) -> slice:
        """Windows of a split: fit, val, train (fit and val) or test."""
        a, b = {"fit": (0, self.row["fit_size"]), "val": (self.row["fit_size"], self.row["train_size"]),
                "train": (0, self.row["train_size"]), "test": (self.row["train_size"], self.row["n_windows"])}[split]
        return slice(*np.clip([a - self.first, b - self.first], 0, self.n))


def each_block(batch: pa.RecordBatch, lay: Layout) -> Iterator[Windows]:
    for k in range(batch.num_rows):
        row = {}
        for name in batch.schema.names:
            cell = batch.column(name)[k]
            row[name] = cell.values.to_numpy(zero_copy_only=False) if pa.types.is_list(cell.type) else cell.as_py()
        yield Windows(row, lay)


def map_windows(blocks: DataFrame, lay: Layout, fn: Callable[[Windows], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` on the windows of every block; its record batches are the rows of the result."""
    def run(batches):
        for b in batches:
            for w in each_block(b, lay):
                yield fn(w)
    return arrow_map(blocks, run, schema)
