"""op1: unigram token counts."""

from __future__ import annotations

from . import tokencount
from .tables import documents

MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark, sf_dir):
    """Words and unigram tokens of every whole document."""
    return tokencount.token_counts(documents(spark, sf_dir), model_path())
