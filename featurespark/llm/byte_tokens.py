"""Ids of byte-level BPE vocabularies (``byte_bpe_50k.json``), cut into pieces.

The vocabulary is read from the tokenizers file. Merging runs in tiktoken, which gives the same
ids several times faster; special strings in a text become their special ids as the tokenizers
library does by default.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from featurespark.llm.bpe_backtrack import byte_letters

# Word pattern of byte-level pre-tokenizers: fixed by the format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def byte_encoder(path: str):
    """A function from a text to its ids as a uint32 array."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for token in special:
        ranks.pop(token.encode(), None)
    encoding = tiktoken.Encoding(
        "byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special
    )
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return 1 + max(*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]))


def piece_starts(n: int, capacity: int, short_first: bool) -> list[int]:
    """Where the pieces of ``n`` ids start: one piece, or pieces of ``capacity`` but for one.

    The shorter one is the first, or without ``short_first`` the last.
    """
    if n <= capacity:
        return [0]
    first = (n % capacity or capacity) if short_first else capacity
    return [0, *range(first, n, capacity)]


def with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, np.uint32(end_id)).astype(np.uint32)
