"""op8: hierarchical multi-length packing."""

from __future__ import annotations

from . import packing
from .tables import documents

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_packing(spark, sf_dir):
    """Every document's tokens in sequences of at most 2048."""
    return packing.packed(documents(spark, sf_dir), tokenizer_path())
