"""Vocabularies of public tokenizers, read on the driver and sent to the tasks as bytes."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def byte_pair_counter(ranks: bytes) -> Callable[[str], int]:
    """Number of byte-pair tokens of a text."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


@lru_cache(maxsize=2)
def pieces(model: bytes) -> list[str]:
    """The pieces of a SentencePiece model, in order of their ids."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [processor.id_to_piece(i) for i in range(processor.vocab_size())]
