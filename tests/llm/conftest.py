"""Shared inputs: documents with every oddity the operators define a result for."""

import public_tokenizers
import pytest

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
# Names that operators use inside; as extra columns they must not get in the way.
CLASHING = "id fp norm digest content key bin place row spread head score lang".split()

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog, again and again."),
    (2, "the QUICK brown fox jumps over the lazy dog, again and again."),
    (3, "the QUICK brown fox jumps over the lazy dog, again and again."),
    (3, "the QUICK brown fox jumps over the lazy dog, again and again."),
    (4, ""),
    (5, None),
    (6, "  \n\t "),
    (7, "word " * 40_000),
    (8, "x" * 30_000),
    (9, "<|endoftext|> naïve Σίσυφος 你好 \U0001f600 I'll it's <|startoftext|>"),
    (None, "a document without an id"),
    (None, "a document without an id"),
    (10, "a document without an id"),
    (None, None),
    (-5, "negative ids are ids"),
]


@pytest.fixture(scope="session")
def odd_rows():
    return TEXTS


@pytest.fixture(scope="session")
def odd_docs(spark):
    extra = ", ".join(f"{c} string" for c in CLASHING)
    rows = [(i, t, *(f"{c}!" for c in CLASHING)) for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
