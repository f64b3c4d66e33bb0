"""Small things several operators of this package share."""

from __future__ import annotations

import public_tokenizers

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
