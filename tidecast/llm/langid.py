"""Language identification by multilingual mixture inference.

Method. Byte trigrams of the lower-cased letters give one distribution per
language (add-``ALPHA`` smoothing, hashed into ``BUCKETS`` cells), learned from
all labelled rows that the caller marks for training. A document is cut into
units of ``UNIT`` trigrams; unit u has log-likelihood L[u, l] under language l. A
set S of languages with proportions pi explains the document with
sum_u log sum_{l in S} pi_l exp L[u, l]; expectation-maximisation estimates pi.
Languages join the set one by one while the gain exceeds ``PENALTY`` log(units)
(a penalised likelihood). The prediction is the language of the largest
proportion, the score that proportion. The gain of any larger set is at most
sum_u max_l L[u, l] minus the best single language's likelihood: where that bound
is below the penalty the single language is the answer and EM is not run.

Plan. Training is one Arrow pass that yields the counts of each task as
(lang, bucket, n) rows and one sum; the rows of a task are bounded by languages
times buckets, so a language with a third of all rows is combined before the
shuffle. Only the model, languages x BUCKETS numbers, goes through the driver
(at most ``MAX_LANGUAGES``; more is an error, never a cut). Prediction is one Arrow
pass without a shuffle over the whole texts.

Defined results. Null text, no letter, or nothing learned: ``und`` with score 0.
Null language or null doc_id (the query): not a training row. Ties: the language first in alphabetical
order. Every row gives one row. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as ta
from .tables import arrow_map

BUCKETS = 1 << 16
UNIT = 64
ALPHA = 0.5
#: Trigrams overlap, so each byte is seen three times: likelihoods are divided by three.
OVERLAP = 3.0
PENALTY = 2.0
MAX_LANGUAGES = 256
EM_STEPS = 60

_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100, dtype=np.uint8)
_LETTER[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1, dtype=np.uint8)
_LETTER[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1, dtype=np.uint8)


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return any(map(str.isalpha, text.decode("utf-8", "replace").replace("�", " ")))


def trigrams(text: bytes | None) -> np.ndarray:
    """Bucket of every byte trigram of the letters, word edges as one blank."""
    buf = _LETTER[np.frombuffer(b" " + (text or b"") + b" ", dtype=np.uint8)]
    blank = buf == 0x20
    buf = buf[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint32)
    if len(buf) < 3:
        return np.empty(0, dtype=np.uint32)
    h = buf[:-2] * np.uint32(0x9E3779B1) + buf[1:-1] * np.uint32(0x85EBCA77) + buf[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.uint32)


def _training_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(batch.schema.names.index("lang")).to_pylist()
        for lang, text in zip(langs, ta.texts_of(batch.column(batch.schema.names.index("text")))):
            t = trigrams(text)
            if len(t):
                if lang not in total:
                    total[lang] = np.zeros(BUCKETS, dtype=np.int64)
                np.add.at(total[lang], t, 1) if len(t) < 4096 else \
                    np.add(total[lang], np.bincount(t, minlength=BUCKETS), out=total[lang])
    for lang, counts in total.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)),
                                          pa.array(counts[seen])], names=["lang", "bucket", "n"])


class Model:
    """Log-probability of every bucket under every language, languages in order."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts.astype(np.float64) + ALPHA
        self.table = np.ascontiguousarray(
            (np.log(smooth / smooth.sum(axis=0)) / OVERLAP).astype(np.float32)) if langs else np.empty((BUCKETS, 0))

    def units(self, text: bytes) -> np.ndarray:
        t = trigrams(text)
        step = UNIT * 4096
        return np.concatenate([np.add.reduceat(self.table[t[i:i + step]], np.arange(0, len(t[i:i + step]), UNIT), axis=0)
                               for i in range(0, len(t), step)]).astype(np.float64)

    def mixture(self, text: bytes) -> dict[str, float]:
        """Proportions of the selected languages of a text that has letters."""
        ll = self.units(text)
        single = ll.sum(axis=0)
        best = int(np.argmax(single))
        penalty = PENALTY * np.log(len(ll) + 1)
        if ll.max(axis=1).sum() - single[best] <= penalty:
            return {self.langs[best]: 1.0}
        chosen, pi, fit = [best], np.ones(1), single[best]
        while len(chosen) < len(self.langs):
            trials = [(*em(ll[:, chosen + [k]]), k) for k in range(len(self.langs)) if k not in chosen]
            fit_k, pi_k, k = max(trials, key=lambda x: (x[0], -x[2]))
            if fit_k - fit <= penalty:
                break
            chosen, pi, fit = chosen + [k], pi_k, fit_k
        return {self.langs[k]: float(p) for k, p in zip(chosen, pi)}

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text) or not len(trigrams(text)):
            return "und", 0.0
        pi = self.mixture(text)
        lang = min(pi, key=lambda k: (-pi[k], k))
        return lang, min(1.0, max(0.0, pi[lang]))


def em(ll: np.ndarray) -> tuple[float, np.ndarray]:
    """(log-likelihood, proportions) of a mixture over the columns of ``ll``."""
    top = ll.max(axis=1)
    like = np.exp(ll - top[:, None])
    pi = np.full(ll.shape[1], 1.0 / ll.shape[1])
    for _ in range(EM_STEPS):
        mass = like * pi
        new = (mass / mass.sum(axis=1, keepdims=True)).mean(axis=0)
        done = np.abs(new - pi).max() < 1e-6
        pi = new
        if done:
            break
    return float((np.log((like * pi).sum(axis=1)) + top).sum()), pi


def train(labelled: DataFrame) -> Model:
    """The model of all rows (lang, text) with a language; counts are summed over every row."""
    src = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = arrow_map(src, _training_counts, "lang string, bucket int, n bigint") \
        .groupBy("lang", "bucket").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    langs = sorted(r[0] for r in src.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the training rows")
    t = counts.toArrow()
    langs = sorted(set(t.column("lang").to_pylist()))
    table = np.zeros((BUCKETS, len(langs)), dtype=np.int64)
    place = {x: i for i, x in enumerate(langs)}
    table[t.column("bucket").to_numpy(), [place[x] for x in t.column("lang").to_pylist()]] = t.column("n").to_numpy()
    return Model(langs, table)


def _predictions(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            keep = [i for i, n in enumerate(batch.schema.names) if n != "text"]
            said = [model.predict(t) for t in ta.texts_of(batch.column(batch.schema.names.index("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array([s[0] for s in said], pa.string()),
                                                   pa.array([s[1] for s in said], pa.float64())],
                names=[batch.schema.names[i] for i in keep] + ["lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of (doc_id, ..., text) with lang_pred and score in place of the text; input columns of
    these two names are replaced."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "text")
    return arrow_map(docs, _predictions(shared), kinds + "lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
