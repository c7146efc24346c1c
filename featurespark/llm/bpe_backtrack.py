"""Exact BPE in linear time: Aho-Corasick matches, pair compatibility and backtracking.

A sequence of tokens is the BPE encoding of a word exactly if each token is the encoding of its own
bytes and no two neighbours would have merged across their boundary. So the encoder takes the
longest match at each place, checks it against the token before, tries shorter matches, and steps
back where none fits; places found to lead nowhere are not tried again.

Decoding gathers bytes from one blob of all tokens through a table of offsets.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import slices, text_or_empty
from featurespark.llm.words import Bounded, load_tokenizer, plain_words

# Stands for the end of a word: a character that no byte maps to.
END = "\n"
# Words and token pairs a worker remembers, and documents it takes at a time.
WORDS_KEPT = 300_000
PAIRS_KEPT = 1_000_000
ROWS_AT_ONCE = 128


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tables of one BPE vocabulary with word ends, from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        self.text = {i: self.marked(token) for token, i in ids.items()}
        self.length = {i: len(text) for i, text in self.text.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(ids.values(), -1)
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = ids[left], ids[right]
            token = ids[left.removesuffix(self.suffix) + right if self.suffix else left + right]
            if max(self.rank[a], self.rank[b]) >= rank or token in self.parts:
                raise ValueError("merges must build each token once, from earlier ones")
            self.parts[token], self.rank[token], self.merged[a, b] = (a, b), rank, rank
        self.fits = Bounded(lambda pair: self.compatible(*pair), PAIRS_KEPT)
        whole = {
            i
            for i, (a, b) in sorted(self.parts.items(), key=lambda item: self.rank[item[0]])
            if self.compatible(a, b, self.rank[i])
        } | {i for i in self.rank if i not in self.parts}
        self.ids = {self.text[i]: i for i in sorted(whole)}
        self.matches = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.matches.add_word(text, i)
        self.matches.make_automaton()
        self.shorter = Bounded(self.shorter_prefix, len(ids))
        self._offsets({i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()})

    def marked(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            return token.removesuffix(self.suffix) + END
        return token

    def _offsets(self, tokens: dict[int, str]) -> None:
        # Without a decoder in the file, the library joins tokens by blanks.
        pieces = [(tokens.get(i, "") + " ").encode() for i in range(max(tokens) + 1)]
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.offset = np.cumsum([0, *map(len, pieces)])

    def compatible(self, a: int, b: int, end: float = float("inf")) -> bool:
        """Whether tokens ``a`` and ``b`` stay apart, up to the merge numbered ``end``.

        Merges are undone from the last one on. While the right edge of ``a`` is ``u`` and the left
        edge of ``b`` is ``v``, they would merge if their rank came before the merges that made
        their successors; at equal ranks the place further left comes first.
        """
        rank, parts, merged = self.rank, self.parts, self.merged
        u, v, after_u, after_v = a, b, end, end
        while True:
            cross = merged.get((u, v))
            if cross is not None and cross < after_u and (cross <= after_v and cross < end):
                return False
            if rank[u] > rank[v]:
                after_u, u = rank[u], parts[u][1]
            elif rank[v] >= 0:
                after_v, v = rank[v], parts[v][0]
            else:
                return True

    def shorter_prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        text = self.text[token]
        return next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), -1)

    def encode_word(self, word: str) -> list[int]:
        """The token ids of a word given as byte letters and, if the vocabulary has ends, END."""
        if word in self.ids:
            return [self.ids[word]]
        longest = [-1] * len(word)
        for last, token in self.matches.iter(word):
            longest[last + 1 - self.length[token]] = token
        length, fits, shorter = self.length, self.fits, self.shorter
        tokens: list[int] = []
        open_places = [True] * (len(word) + 1)
        place, token = 0, longest[0]
        while place < len(word):
            while token >= 0:
                end = place + length[token]
                if open_places[end] and (not tokens or fits[tokens[-1], token]):
                    break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                place = end
                token = longest[place] if place < len(word) else -1
            elif tokens:
                open_places[place] = False
                token = tokens.pop()
                place -= length[token]
            else:
                raise ValueError(f"no encoding of {word!r}")
        return tokens

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens, joined by blanks."""
        starts, sizes = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        return self.blob[places[:-1]].tobytes()


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Whole texts to ids: the library's words, this module's tokens."""

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = load_vocabulary(path)
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.words = Bounded(self.word_ids, WORDS_KEPT)

    def word_ids(self, word: str) -> bytes:
        return self.mapped_ids(word.encode().decode("latin-1").translate(self.letters))

    def mapped_ids(self, mapped: str) -> bytes:
        end = END if self.vocabulary.suffix else ""
        return np.array(self.vocabulary.encode_word(mapped + end), np.uint32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        words = plain_words(text)
        if words is not None:
            return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint32)
        return np.frombuffer(b"".join(self.library_words(text)), np.uint32)

    def library_words(self, text: str) -> Iterator[bytes]:
        """Ids of a text with other scripts or special strings, word by word."""
        tokenizer, place = load_tokenizer(self.path), 0
        special = self.vocabulary.special
        # Where each special string comes next; it is sought again only once that is passed.
        coming = {s: text.find(s) for s in special}
        while place < len(text):
            for s in [s for s, at in coming.items() if 0 <= at < place]:
                coming[s] = text.find(s, place)
            at, string = min(((at, s) for s, at in coming.items() if at >= 0), default=(len(text), ""))
            plain = tokenizer.normalizer.normalize_str(text[place:at])
            for mapped, _ in tokenizer.pre_tokenizer.pre_tokenize_str(plain) if plain else []:
                yield self.mapped_ids(mapped)
            if string:
                yield np.array([special[string]], np.uint32).tobytes()
            place = at + len(string)


def encode_texts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, ids array<int>`` for every row: the ids the tokenizers library gives.

    No special tokens are added; special strings in a text are found as the library finds them.
    Null counts as the empty text, which has no ids. Repeated rows and null ids give a row each,
    an empty table none. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in slices(batches, ROWS_AT_ONCE):
            ids = [encoder.encode(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_ids(
    encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``id_col, text`` for every row of ids, special tokens kept; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(tokenizer_path)
        for batch in slices(batches, ROWS_AT_ONCE):
            texts = [
                vocabulary.decode(np.array(ids.as_py() or [], np.int64)).decode()
                for ids in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts)], [id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(id_col, F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip_digests(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of every row, in one pass.

    As ``encode_texts`` followed by ``decode_ids``, with digests of the decimal ids joined by one
    blank and of the decoded text. The same rules hold for nulls, repeated rows and empty tables.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        vocabulary = encoder.vocabulary
        numbers = [str(i) for i in range(len(vocabulary.offset) - 1)]
        for batch in slices(batches, ROWS_AT_ONCE):
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = encoder.encode(text.as_py()).astype(np.int64)
                counts.append(len(ids))
                listed = " ".join([numbers[i] for i in ids.tolist()]).encode()
                of_ids.append(hashlib.sha256(listed).hexdigest())
                of_text.append(hashlib.sha256(vocabulary.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
