"""Token counts: a unigram forward pass shared over a trie of pre-tokens.

Method. The vocabulary of a public tokenizer file serves as a unigram inventory:
the piece of rank r (order in the file) has cost log(r + 2), a Zipf prior, and a
character that no piece covers falls back to its UTF-8 bytes at ``BYTE_COST``
each. A pre-token is a word with the word mark in front; its token count is the
length of its cheapest segmentation (of equal cost, the fewest tokens). Distinct
pre-tokens are inserted into a trie by sorting them, so that neighbours share
their prefix: the forward cost of a prefix depends on the prefix alone and is
computed once, for the part behind the longest common prefix with the previous
pre-token. The count at the end of a pre-token is stored and looked up for every
occurrence.

Plan. One Arrow pass, no shuffle: each task shares prefixes within the distinct
words of a batch and keeps terminal counts in a bounded table. Counts do not
depend on how documents are dealt to tasks.

Defined results. Null or blank text: 0 words, 0 tokens. Every input row gives one
row; rows may repeat; other columns are ignored; empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import textarrays as ta
from .tables import arrow_map

WORD_MARK = "▁"
BYTE_COST = 14.0
#: Terminal counts kept per worker; when full the table starts anew (results do not change).
TERMINALS = 300_000
#: Bytes of text whose distinct words share one trie.
GROUP = 4 << 20


class Unigram:
    """Piece costs, stored as a trie of reversed pieces so that all pieces that
    end at a position are found by walking backwards from it."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.root: dict = {}
        for rank, piece in enumerate(pieces):
            node = self.root
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node.setdefault(None, math.log(rank + 2))

    def counts(self, words: list[str]) -> list[int]:
        """Token counts of pre-tokens given in sorted order."""
        root, out = self.root, []
        previous, cost, count = "", [0.0], [0]
        for w in words:
            shared = 0
            for a, b in zip(previous, w):
                if a != b:
                    break
                shared += 1
            del cost[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(w) + 1):
                size = len(w[end - 1].encode("utf-8", "surrogatepass"))
                best, tokens = cost[end - 1] + BYTE_COST * size, count[end - 1] + size
                node, at = root, end
                while at:
                    at -= 1
                    node = node.get(w[at])
                    if node is None:
                        break
                    piece = node.get(None)
                    if piece is not None:
                        c = cost[at] + piece
                        if c < best or (c == best and count[at] + 1 < tokens):
                            best, tokens = c, count[at] + 1
                cost.append(best)
                count.append(tokens)
            out.append(count[len(w)])
            previous = w
        return out


_LOADED: dict[str, tuple[Unigram, dict[bytes, int]]] = {}


def _count_batches(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _LOADED:
            _LOADED[model_path] = (Unigram(model_path), {})
        model, known = _LOADED[model_path]
        for batch in batches:
            ids = batch.column(batch.schema.names.index("doc_id"))
            for group in ta.groups(enumerate(ta.texts_of(batch.column(batch.schema.names.index("text")))), GROUP):
                rows = [(t or b"").split() for _, t in group]
                fresh = {w for r in rows for w in r}.difference(known)
                if len(known) + len(fresh) > TERMINALS:
                    known.clear()
                    fresh = {w for r in rows for w in r}
                order = sorted((WORD_MARK + w.decode("utf-8", "surrogateescape"), w) for w in fresh)
                known.update(zip((w for _, w in order), model.counts([s for s, _ in order])))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(group[0][0], len(group)), pa.array([len(r) for r in rows], pa.int64()),
                     pa.array([sum(map(known.__getitem__, r)) for r in rows], pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words and n_tokens of every document under the unigram of ``model_path``."""
    src = docs.select("doc_id", "text")
    return arrow_map(src, _count_batches(model_path),
                     f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_tokens bigint")
