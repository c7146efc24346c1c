"""Word splitting of lower-casing BPE tokenizers with word ends (``word_bpe_49k.json``).

Most texts are plain Latin script without special strings: one regular expression splits them.
Any other text goes through the normaliser and the pre-tokenizer of the ``tokenizers`` library,
so both ways give the library's words.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

# A character outside the ranges that the plain way covers, or the start of a special string.
NOT_PLAIN = re.compile("[^\\x00-įı-ſ‐-‧€]|<\\|")
LETTERS = "a-zªµºß-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \u0085\u00a0"
PLAIN_WORD = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+"
)


def plain_words(text: str) -> list[str] | None:
    """The words of ``text``, or None if it needs the library's own steps."""
    return None if NOT_PLAIN.search(text) else PLAIN_WORD.findall(text.lower())


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The library's tokenizer, without truncation and padding, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Bounded(dict):
    """A memo that starts afresh when it holds ``most`` entries."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value
