"""Quality classifier by compression: zstandard dictionaries of good and bad text.

Method. Labelled texts are cut into blocks of ``block`` bytes. A sample of the blocks
of each label trains one zstandard dictionary. A text is compressed whole, block by
block, once with each dictionary; a text like the good ones gets smaller with the good
dictionary. The difference (bad size - good size) / bytes of the text, independent of its
length, becomes a probability by a logistic curve. The curve also sees the size without a
dictionary per byte: a text of repeated words shrinks to nothing with any dictionary, and
the difference with it. It is fitted across ``FOLDS`` folds of the labelled texts: the
differences of a fold come from dictionaries of the others. The final dictionaries are
those of all folds.

Bounds of the fit (``Settings``, all documented parameters): at most ``sample_rows``
labelled ids of each label, ``sample_blocks`` distinct blocks of each label and fold and
``sample_scores`` texts for the curve, each the first in the order of a hash. So the
sample joins the texts as a broadcast of at most 2 * ``sample_rows`` ids, without a
shuffle of texts, and the driver holds at most 2 * ``FOLDS`` * ``sample_blocks`` *
``block`` bytes. Each task sends only its own first ``sample_blocks`` distinct blocks of a
label and fold: a text that a third of all rows repeat counts once. Scoring is one Arrow
pass over the whole texts without a shuffle; memory is one text and the two dictionaries.

Defined results. Null and empty texts have no difference; their score is the share of
label 1 among the sampled ids, with add-one smoothing. A document with labels 0 and 1 counts as 0; labels other than 0 and 1, null
labels and null ids teach nothing. Repeated rows are scored alike, each in its own row.
With labels of one kind only every score is that share, without labels 0.5.
Too few samples for a trained dictionary: the blocks themselves are the dictionary. Other
columns of the inputs are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import arrow_map, stored


#: Folds of the labelled texts.
FOLDS = 3


@dataclass(frozen=True)
class Settings:
    block: int = 2048
    dictionary: int = 65536
    level: int = 3
    sample_rows: int = 20_000
    sample_blocks: int = 1400
    sample_scores: int = 20_000


@dataclass(frozen=True)
class Model:
    """Dictionaries of the two labels (None: no text of it), the logistic curve's weights of the
    difference, the plain size and one, and the share of label 1, the score where there is no text."""
    good: bytes | None
    bad: bytes | None
    curve: tuple[float, float, float]
    share: float
    settings: Settings

    def probability(self, inputs: np.ndarray) -> np.ndarray:
        """Scores of (difference, plain size) rows; NaN: no text."""
        z = inputs @ np.array(self.curve[:2]) + self.curve[2]
        return np.where(np.isnan(z), self.share, 1.0 / (1.0 + np.exp(-np.clip(np.nan_to_num(z), -500, 500))))


def held_out(doc_id: Column) -> Column:
    """True for the rows no label of which may be learned (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    for at in range(0, len(text), size):
        yield text[at:at + size]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts of a batch one by one (null: empty)."""
    column = batch.column("text").cast(pa.large_binary())
    for k in range(len(column)):
        yield column[k].as_py() or b""


def _block_sample(s: Settings):
    """Per task: the first ``sample_blocks`` distinct blocks of each label and fold in the order of their hashes."""
    def run(batches):
        first: dict[tuple[int, int], dict[bytes, bytes]] = {}
        for b in batches:
            for text, *group in zip(_texts(b), b.column("quality").to_pylist(), b.column("fold").to_pylist()):
                mine = first.setdefault(tuple(group), {})
                for piece in _pieces(text, s.block):
                    mine[hashlib.blake2b(piece, digest_size=16).digest()] = piece
                    if len(mine) > 4 * s.sample_blocks:
                        for h in sorted(mine)[s.sample_blocks:]:
                            del mine[h]
        for (q, fold), mine in first.items():
            keep = sorted(mine)[:s.sample_blocks]
            yield pa.RecordBatch.from_arrays(
                [pa.array([q] * len(keep), pa.int32()), pa.array([fold] * len(keep), pa.int32()), pa.array(keep, pa.binary()),
                 pa.array([mine[h] for h in keep], pa.binary())], ["quality", "fold", "h", "piece"])
    return run, "quality int, fold int, h binary, piece binary"


def _dictionary(pieces: list[bytes], s: Settings) -> bytes | None:
    pieces = [p for p in pieces if len(p) >= 8]
    if not pieces:
        return None
    try:
        return zstandard.train_dictionary(s.dictionary, pieces).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(pieces)[-s.dictionary:]


def _sizes(good: bytes, bad: bytes, s: Settings):
    """A function from a text to its compressed sizes with the bad, the good and no dictionary."""
    one = [zstandard.ZstdCompressor(level=s.level, write_checksum=False, write_content_size=False, write_dict_id=False,
                                    dict_data=d and zstandard.ZstdCompressionDict(d)) for d in (bad, good, None)]

    def sizes(text: bytes) -> tuple[int, ...]:
        return tuple(sum(len(c.compress(p)) for p in _pieces(text, s.block)) for c in one)
    return sizes


def _inputs(text: bytes, sizes) -> tuple[float, float]:
    """The curve's inputs: the difference of the dictionaries' sizes and the plain size, per byte of the text."""
    if not text or sizes is None:
        return np.nan, np.nan
    bad, good, plain = sizes(text)
    return (bad - good) / len(text), plain / len(text)


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Weights of the logistic curve through the labels, by damped Newton steps with a small ridge."""
    mid, width = x.mean(axis=0), x.std(axis=0)
    width[width == 0] = 1.0
    a = np.c_[(x - mid) / width, np.ones(len(x))]
    ridge, w = np.array([0.05, 0.05, 1e-9]), np.zeros(3)

    def loss(w):
        z = a @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + (ridge * w * w).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (p - y) + ridge * w)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-12:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    one = w[:2] / width
    return float(one[0]), float(one[1]), float(w[2] - one @ mid)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The model of ``docs`` (doc_id, text) under ``labels`` (doc_id, quality)."""
    s = settings
    known = (labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("quality")))
    order = F.xxhash64("doc_id")
    sample = stored(known.filter("quality = 0").orderBy(order, "doc_id").limit(s.sample_rows)
                    .unionByName(known.filter("quality = 1").orderBy(order, "doc_id").limit(s.sample_rows)), "quality_sample")
    rows = (docs.select("doc_id", "text").filter("text <> ''").join(F.broadcast(sample), "doc_id")
            .select("quality", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"), F.xxhash64("text").alias("h"), "text"))
    n0, n1 = (sample.filter(F.col("quality") == q).count() for q in (0, 1))
    share = (n1 + 1) / (n0 + n1 + 2)

    blocks = stored(arrow_map(rows.select("quality", "fold", "text"), *_block_sample(s))
                    .groupBy("quality", "fold", "h").agg(F.first("piece").alias("piece")), "quality_blocks")
    pieces = {(q, f): [bytes(r.piece) for r in blocks.filter((F.col("quality") == q) & (F.col("fold") == f))
                       .orderBy("h").limit(s.sample_blocks).collect()] for q in (0, 1) for f in range(FOLDS)}

    def pair(without: int | None) -> tuple[bytes | None, bytes | None]:
        """Good and bad dictionary of all folds but one."""
        return tuple(_dictionary([p for f in range(FOLDS) if f != without for p in pieces[q, f]], s) for q in (1, 0))

    good, bad = pair(None)
    if good is None or bad is None:
        return Model(None, None, (0.0, 0.0, 0.0), share, s)
    # a table too small to leave a fold out is scored with the final dictionaries
    others = [p if None not in p else (good, bad) for p in map(pair, range(FOLDS))]

    def measure(batches):
        sizes = [_sizes(*p, s) for p in others]
        for b in batches:
            x = np.array([_inputs(t, sizes[f]) for t, f in zip(_texts(b), b.column("fold").to_pylist())]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("quality"), b.column("h"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                             ["quality", "h", "difference", "size"])

    measured = arrow_map(rows, measure, "quality int, h bigint, difference double, size double")
    got = measured.distinct().orderBy("h", "quality", "difference").limit(s.sample_scores).collect()
    curve = _calibrate(np.array([(r.difference, r.size) for r in got]), np.array([float(r.quality) for r in got]))
    return Model(good, bad, curve, share, s)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row."""
    def run(batches):
        sizes = _sizes(model.good, model.bad, model.settings) if model.good else None
        for b in batches:
            x = np.array([_inputs(t, sizes) for t in _texts(b)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.probability(x))], ["doc_id", "score"])
    return arrow_map(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, score double")
