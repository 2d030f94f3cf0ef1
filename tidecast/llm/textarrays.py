"""Vectorised text primitives on UTF-8 bytes (numpy), shared by the operators.

A word here is a maximal run of bytes outside 0x20 and 0x09-0x0D, i.e. the
character class ``[^\\x20\\x09-\\x0D]+`` (all separators are single bytes, so
byte runs and code-point runs coincide). Texts are processed in pieces of at
most ``CHUNK`` bytes cut at a separator, so memory does not follow the length
of the longest document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
MASK64 = (1 << 64) - 1

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection of 64-bit values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values that depend on the seed only."""
    base = (seed * 0x9E3779B97F4A7C15 + 0x1234567) & MASK64
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(base)
    return mix(steps)


_TABLES: dict[int, np.ndarray] = {}


def _table(seed: int, n: int) -> np.ndarray:
    t = _TABLES.get(seed)
    if t is None or len(t) < n:
        t = _TABLES[seed] = stream(seed, max(256, 1 << (n - 1).bit_length()))
    return t


def texts_of(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, None for null, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    for v in column.cast(pa.large_binary() if big else pa.binary()):
        yield v.as_py()


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about CHUNK bytes that end at a separator."""
    lo, n = 0, len(text)
    while n - lo > CHUNK:
        hi = max(text.rfind(s, lo, lo + CHUNK) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if hi <= lo:  # one word longer than a piece: take it whole
            nxt = [i for i in (text.find(s, lo + CHUNK) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if i >= 0]
            hi = min(nxt) if nxt else n - 1
        yield text[lo:hi + 1]
        lo = hi + 1
    if lo < n:
        yield text[lo:]


def _hash_piece(buf: np.ndarray, seed: int) -> np.ndarray:
    word = ~_SPACE[buf]
    if not word.any():
        return np.empty(0, dtype=np.uint64)
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    inside = buf[word].astype(np.uint64)
    pos = np.arange(len(inside)) - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        terms = (inside + np.uint64(1)) * _table(seed, int(lens.max()))[pos]
        return mix(np.add.reduceat(terms, first) + lens.astype(np.uint64))


def word_hashes(text: bytes | None, seed: int = 1, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word in order (empty for null or blank text)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    out = []
    for piece in _pieces(text) if len(text) > CHUNK else (text,):
        buf = np.frombuffer(piece, dtype=np.uint8)
        out.append(_hash_piece(_LOWER[buf] if lower else buf, seed))
    return out[0] if len(out) == 1 else np.concatenate(out)


def many_word_hashes(texts: list[bytes | None], seed: int = 1, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts laid end to end, and the n+1 offsets of the
    texts in that array. Texts are hashed together up to CHUNK bytes at a time
    (a separator keeps the words of neighbours apart)."""
    parts, counts, group, size = [], [], [], 0

    def flush() -> None:
        if not group:
            return
        if len(group) == 1:
            h = word_hashes(group[0], seed, lower)
            parts.append(h)
            counts.append(len(h))
            return
        buf = np.frombuffer(b"\n".join(group), dtype=np.uint8)
        buf = _LOWER[buf] if lower else buf
        parts.append(_hash_piece(buf, seed))
        word = ~_SPACE[buf]
        begins = np.concatenate(([0], np.cumsum(np.diff(word.view(np.int8), prepend=np.int8(0)) == 1)))
        lens = np.array([len(g) + 1 for g in group])
        hi = np.minimum(np.cumsum(lens), len(buf))
        counts.extend(np.diff(begins[hi], prepend=0).tolist())

    for t in texts:
        t = t or b""
        if size + len(t) > CHUNK and group:
            flush()
            group, size = [], 0
        group.append(t)
        size += len(t) + 1
    flush()
    hashes = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)
    return hashes, np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def ngram_hashes(words: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (len - n + 1 values)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    mult = _table(seed, n) | np.uint64(1)
    m = len(words) - n + 1
    with np.errstate(over="ignore"):
        acc = words[:m] * mult[0]
        for j in range(1, n):
            acc += mix(words[j:j + m] + mult[j])  if j % 2 else words[j:j + m] * mult[j]
    return mix(acc)


def groups(items: Iterable[tuple[int, bytes | None]], limit: int = 4 * CHUNK) -> Iterator[list[tuple[int, bytes | None]]]:
    """Consecutive (row, text) pairs in groups of about ``limit`` bytes."""
    out, size = [], 0
    for i, t in items:
        n = len(t) if t else 0
        if out and size + n > limit:
            yield out
            out, size = [], 0
        out.append((i, t))
        size += n
    if out:
        yield out
