"""Hierarchical multi-length packing.

Method. Every document becomes token ids plus an end id. Whole windows of
``tiers[0]`` tokens are sequences of their own; the rest of a document is routed
to the smallest context tier that holds it. Tiers are packed from long to short:
each rest opens a window of its tier, the gap is filled best-fit by whole rests
of shorter tiers, then by the head of a shorter rest cut to the remaining gap
(its tail stays in the pool). All windows are powers of two, so a filled window
has no padding. What is left when a task ends is laid end to end and cut into
descending powers of two. Windows of one tier are dealt to step groups of
``step_tokens`` tokens each over all tasks, so every step sees the same number of
tokens; only the last group of a tier can have fewer.

Plan. One Arrow pass without a shuffle: a task packs the documents it reads and
numbers its windows per tier. The pieces are stored; the windows of each task and
tier are counted, and the sums over the tasks before (a row per task and tier) make
the numbers global. The
pool holds at most ``POOL`` rests of under one window. Ids come from the public
tokenizer, asked once per distinct word and worker (``STEMS`` words are kept); this
equals encoding the whole text, since the tokenizer never joins across white
space and never joins a letter or digit with a following ``,.;:!?`` (``WordIds``).

Defined results. Null or empty text: the end id alone. Rows are packed one by
one, repeated and null doc_ids included. Sequence ids are unique in the result:
the task's partition number and a counter, equal again if a task is run again.
Empty table: no rows.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textarrays as ta
from .tables import arrow_map, small, stored

TIERS = (2048, 1024, 512, 256)
STEP_TOKENS = 65_536
POOL = 4096
#: Bytes of text whose new words are learned together.
GROUP = 1 << 20
STEMS = 800_000
END_ID = 1


class WordIds:
    """Token ids of texts by way of their words, in arrays.

    The bytes of a group of texts are lower-cased (ASCII) and cut into words; a
    ``.,;:!?`` that ends a word after an ASCII letter or digit is a token of its own.
    The tokenizer lower-cases as well and keeps such a sign apart, so the ids are
    those of the whole text; texts with combining marks or special-token signs, where
    that could matter, are encoded whole. Words are known by a 64-bit hash. New words
    of ASCII letters are encoded together, as one text, by the same tokenizer without
    the normalising steps that leave such words as they are; each ends with one
    closing id. Where the closing ids do not add up, and for all other words, the
    tokenizer itself is asked word by word.
    """

    def __init__(self, tokenizer_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.ascii, self.letters = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)  # one vocabulary in memory
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a word
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        """Known words: hash -> place; place -> (start, length) in the pool of ids. Place
        0 is empty, the next ones are the signs that end words."""
        self.known: dict[int, int] = {}
        self.pool, self.filled = np.empty(1 << 20, dtype="<u4"), 0
        self.starts, self.lengths, self.places = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64), 1
        self._add([self._one(chr(c)) for c in _TAIL_SIGNS])

    def _one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _add(self, ids: list[np.ndarray]) -> None:
        """Ids of new places, in order."""
        self._add_flat(np.concatenate(ids) if ids else np.empty(0, "<u4"), np.array([len(x) for x in ids], dtype=np.int64))

    def _add_flat(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        while self.places + len(lengths) > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.lengths))
        self.pool[self.filled:self.filled + len(ids)] = ids
        at = slice(self.places, self.places + len(lengths))
        self.starts[at] = self.filled + np.cumsum(lengths) - lengths
        self.lengths[at] = lengths
        self.filled += len(ids)
        self.places += len(lengths)

    def _learn_letters(self, keys: list[int], texts: list[str], words: list[str], tokenizer) -> None:
        """Words given as texts of many words each; ``words`` for the case that they do not add up."""
        for text, k, w in zip(texts, keys, words):
            (e,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            first = self.places
            if len(ends) == len(k):
                self._add_flat(ids, np.diff(ends, prepend=0))
            else:
                self._add([self._one(x) for x in (w or text.split(" "))])
            self.known.update(zip(k, range(first, self.places)))

    def _learn(self, buf: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """New words, given by hash and place in ``buf``."""
        sums = np.concatenate(([0], np.cumsum(_ASCII_LETTER[buf])))
        plain = (sums[ends] - sums[starts]) == ends - starts
        step = 4096
        order = np.flatnonzero(plain)
        for i in range(0, len(order), step):  # laid end to end with a blank between
            some = order[i:i + step]
            size = ends[some] - starts[some] + 1
            at = np.cumsum(size) - size
            text = buf[np.repeat(starts[some] - at, size) + np.arange(at[-1] + size[-1])]
            text[at + size - 1] = 0x20
            self._learn_letters([keys[some].tolist()], [text[:-1].tobytes().decode()], [None], self.ascii)
        text = buf.tobytes()
        letters, others = [], []
        for k, i, j in zip(keys[~plain].tolist(), starts[~plain].tolist(), ends[~plain].tolist()):
            w = text[i:j].decode("utf-8", "replace")
            if w[-1] in _TAIL_TEXT and _only_letters(w[:-1]):
                letters.append((k, w[:-1], w[-1]))
            elif _only_letters(w):
                letters.append((k, w, ""))
            else:
                others.append((k, w))
        for lo in range(0, len(letters), step):
            some = letters[lo:lo + step]
            first = self.places
            self._learn_letters([[k for k, _, _ in some]], [" ".join(w for _, w, _ in some)], [[w for _, w, _ in some]], self.letters)
            for n, (k, _, sign) in enumerate(some):
                if sign:  # the ids of the letters and of the sign
                    at, size = self.starts[first + n], self.lengths[first + n]
                    tail = 1 + _TAIL_TEXT.index(sign)
                    place = self.places
                    self._add([np.concatenate((self.pool[at:at + size], self.pool[self.starts[tail]:self.starts[tail] + self.lengths[tail]]))])
                    self.known[k] = place
        for lo in range(0, len(others), step):
            some = others[lo:lo + step]
            place = self.places
            self._add([np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([w for _, w in some], add_special_tokens=False)])
            self.known.update(zip([k for k, _ in some], range(place, self.places)))

    def ids(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of several texts; new words are learned for all of them at once."""
        if len(texts) == 1 and texts[0] and len(texts[0]) > GROUP:
            return [np.concatenate([self.ids([piece])[0] for piece in ta._pieces(texts[0])])]
        whole = {i: self._one(t.decode("utf-8", "replace")) for i, t in enumerate(texts) if t and any(x in t for x in _TAKE_WHOLE)}
        rows = [b"" if i in whole else t or b"" for i, t in enumerate(texts)]
        buf = ta._LOWER[np.frombuffer(b"\n".join(rows) + b"\n", dtype=np.uint8)]
        word = ~ta._SPACE[buf]
        edge = np.diff(word.view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return [whole.get(i, np.empty(0, dtype="<u4")) for i in range(len(texts))]
        last = _SIGN[buf[ends - 1]]
        tail = np.where((ends - starts > 1) & (last > 0) & _ALNUM[buf[ends - 2]], last, 0)
        word[ends[tail > 0] - 1] = False
        ends = ends - (tail > 0)
        lens = ends - starts
        first = np.cumsum(lens) - lens
        pos = np.arange(first[-1] + lens[-1]) - np.repeat(first, lens)
        with np.errstate(over="ignore"):
            terms = (buf[word].astype(np.uint64) + np.uint64(1)) * ta._table(3, int(lens.max()))[pos]
            keys = ta.mix(np.add.reduceat(terms, first) + lens.astype(np.uint64))
        distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > STEMS:
            self._clear()
        names = distinct.tolist()
        place = np.array([self.known.get(k, -1) for k in names], dtype=np.int64)
        new = place < 0
        if new.any():
            self._learn(buf, distinct[new], starts[at[new]], ends[at[new]])
            place[new] = [self.known[k] for k in distinct[new].tolist()]
        pair = np.empty(2 * len(keys), dtype=np.int64)  # each word and the sign behind it, if any
        pair[0::2], pair[1::2] = place[back], tail
        sizes = self.lengths[pair]
        upto = np.cumsum(sizes)
        out = self.pool[np.repeat(self.starts[pair] - (upto - sizes), sizes) + np.arange(upto[-1])]
        limits = np.cumsum([len(r) + 1 for r in rows])
        cut = np.concatenate(([0], upto[1::2]))[np.searchsorted(starts, limits, "left")]
        return [whole.get(i, out[x:y]) for i, (x, y) in enumerate(zip([0, *cut[:-1]], cut))]


_TAIL_SIGNS = b",.;:!?"
_TAIL_TEXT = _TAIL_SIGNS.decode()
_SIGN = np.zeros(256, dtype=np.int64)
_SIGN[list(_TAIL_SIGNS)] = np.arange(1, len(_TAIL_SIGNS) + 1)
_ASCII_LETTER = np.zeros(256, dtype=np.int64)
_ASCII_LETTER[ord("a"):ord("z") + 1] = 1
_ALNUM = _ASCII_LETTER.astype(bool)
_ALNUM[ord("0"):ord("9") + 1] = True
#: Combining marks U+0300..U+036F in UTF-8, and the opening of a special token.
_TAKE_WHOLE = (b"\xCC", b"\xCD", b"<|")


def _only_letters(t: str) -> bool:
    """All letters, and lower-casing leaves only letters."""
    return t.isalpha() and unicodedata.normalize("NFC", t).lower().isalpha()


@dataclass
class Packer:
    """Packs (row, ids) into windows; ``out`` gets (row, start, length, crc32, doc_tokens,
    sequence, offset, tier, number of the window in its tier) tuples."""
    tiers: tuple[int, ...] = TIERS
    first: int = 0
    out: list = field(default_factory=list)
    pool: list = field(default_factory=list)        # (length, arrival, row, start, ids, doc_tokens), by length
    tokens: int = 0                                 # in the pool
    sequences: int = 0
    arrivals: int = 0
    made: dict = field(default_factory=dict)        # tier -> windows so far

    def add(self, row, ids: np.ndarray) -> None:
        n, top = len(ids), self.tiers[0]
        whole = n - n % top
        for start in range(0, whole, top):
            self._window([(row, start, top, ids[start:start + top], n)], top)
        if n > whole:
            self._keep(row, whole, ids[whole:], n)
        if len(self.pool) >= POOL:
            self.flush()

    def _keep(self, row, start: int, ids: np.ndarray, n: int) -> None:
        insort(self.pool, (len(ids), self.arrivals, row, start, ids, n), key=lambda x: x[:2])
        self.arrivals += 1
        self.tokens += len(ids)

    def _window(self, pieces: list, tier: int) -> None:
        seq, offset = self.first + self.sequences, 0
        self.sequences += 1
        k = self.made.get(tier, 0)
        self.made[tier] = k + 1
        for row, start, length, ids, n in pieces:
            self.out.append((row, start, length, zlib.crc32(np.ascontiguousarray(ids)), n, seq, offset, tier, k))
            offset += length

    def _rest(self, i: int):
        rest = self.pool.pop(i)
        self.tokens -= rest[0]
        return rest

    def flush(self, end: bool = False) -> None:
        """Fill windows, longest tier first, while the pool has tokens to fill them.
        Before the end a few windows' worth stays, so that gaps find short rests."""
        while self.pool:
            length = self.pool[-1][0]
            tier = min(t for t in self.tiers if t >= length)
            if self.tokens < (tier if end else 4 * self.tiers[0]):
                break
            window, gap = [self._rest(-1)], tier - length
            while gap:
                i = bisect_right(self.pool, gap, key=lambda x: x[0]) - 1  # the longest rest that fits
                if i >= 0:
                    rest = self._rest(i)
                else:  # every rest is longer than the gap: cut the shortest
                    n, at, row, start, ids, total = self._rest(0)
                    rest = (gap, at, row, start, ids[:gap], total)
                    self._keep(row, start + gap, ids[gap:], total)
                window.append(rest)
                gap -= rest[0]
            self._window([(row, start, n, ids, total) for n, _, row, start, ids, total in window], tier)
        if end:
            self._tail()

    def _tail(self) -> None:
        """The last rests, end to end, in descending powers of two."""
        while self.tokens:
            size = min(1 << (self.tokens.bit_length() - 1), self.tiers[0])
            window, gap = [], size
            while gap:
                n, at, row, start, ids, total = self._rest(-1)
                take = min(n, gap)
                window.append((row, start, take, ids[:take], total))
                if take < n:
                    self._keep(row, start + take, ids[take:], total)
                gap -= take
            self._window(window, size)


_FIELDS = (("start", pa.int64(), "bigint"), ("length", pa.int64(), "bigint"), ("ids_crc32", pa.int64(), "bigint"),
           ("doc_tokens", pa.int64(), "bigint"), ("sequence_id", pa.int64(), "bigint"), ("offset", pa.int64(), "bigint"),
           ("tier", pa.int32(), "int"), ("k", pa.int64(), "bigint"))
#: Sequence ids of a task begin at its partition number times 2 ** TASK_BITS.
TASK_BITS = 33

_LOADED: dict[str, WordIds] = {}


def _pack_batches(tokenizer_path: str, tiers: tuple[int, ...], id_type: pa.DataType):
    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], id_type)] + [pa.array(c, f[1]) for c, f in zip(cols[1:], _FIELDS)],
                                          names=["doc_id"] + [f[0] for f in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _LOADED.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
        _LOADED[tokenizer_path] = encode
        end = np.array([END_ID], dtype="<u4")
        packer = Packer(tiers, first=TaskContext.get().partitionId() << TASK_BITS)
        for batch in batches:
            rows = batch.column(batch.schema.names.index("doc_id")).to_pylist()
            for group in ta.groups(enumerate(ta.texts_of(batch.column(batch.schema.names.index("text")))), GROUP):
                for (i, _), ids in zip(group, encode.ids([t for _, t in group])):
                    packer.add(rows[i], np.concatenate((ids, end)))
                    if len(packer.out) >= 8192:
                        yield batch_of(packer.out)
                        packer.out.clear()
        packer.flush(end=True)
        if packer.out:
            yield batch_of(packer.out)
    return run


def with_step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """The pieces with ``step_group`` in place of ``k``: windows of a tier are numbered over all
    tasks, in order of the tasks, and every ``step_tokens`` tokens of them are a group."""
    task = F.shiftright("sequence_id", TASK_BITS)
    counts = pieces.groupBy(task.alias("__task"), F.col("tier").alias("__tier")).agg((F.max("k") + 1).alias("n"))
    before = Window.partitionBy("__tier").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("__task", "__tier", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    j = pieces.join(small(stored(first, "packing_first")), (task == F.col("__task")) & (F.col("tier") == F.col("__tier")))
    group = F.expr(f"(__first + k) div greatest(1, {step_tokens} div tier)")
    return j.withColumn("step_group", group).drop("k", "__task", "__tier", "__first")


def packed(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType
    fields = ", ".join(f"{n} {t}" for n, _, t in _FIELDS)
    pieces = arrow_map(src, _pack_batches(tokenizer_path, tuple(tiers), to_arrow_type(kind)),
                       f"doc_id {kind.simpleString()}, {fields}")
    return with_step_groups(stored(pieces, "packing_pieces"), step_tokens)
