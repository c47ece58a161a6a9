"""Where the public vocabulary files lie, and encoders that each worker makes once.

Nothing is copied or trained: a path is a parameter, and every worker reads the file
from its own installation.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def json_tokenizer(path: str):
    """The tokenizers library's encoder, one thread to a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str):
    """The tiktoken library's encoder over a file of ranks, without special tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
