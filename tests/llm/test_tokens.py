"""Token counts, BPE and packing against the tokenizers library."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from featurespark.llm import bfd_matrices, bpe_backtrack, digest_cache, queries, residual_packing, words
from featurespark.llm.byte_tokens import byte_encoder, piece_starts
from tokenizers import Tokenizer

from .conftest import BYTE, WORD


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n):
    rng = random.Random(5)
    odd = [chr(c) for c in [*range(1, 0x250), 0x3A3, 0x301, 0x2028, 0x4F60, 0x1F600, 0x130]]
    plain = "abcdefgh STRE'vm ld\n''aaa1"
    return [
        "".join(rng.choice(odd) if rng.random() < 0.3 else rng.choice(plain) for _ in range(rng.randint(0, 60)))
        for _ in range(n)
    ]


def test_bpe_equals_the_library(word_library):
    encoder = bpe_backtrack.Encoder(WORD)
    letters = [f"a{chr(c)} B{chr(c)}{chr(c)} '{chr(c)}s{chr(c)}1" for c in range(1, 0x2100)]
    for text in [*letters, *random_texts(3000), "ab" * 3000, "!" * 3000, "<|EndOfText|><|endoftext|>x"]:
        want = ids_of(word_library, text)
        got = encoder.encode(text)
        assert got.tolist() == want, text
        decoded = encoder.vocabulary.decode(got.astype(np.int64)).decode()
        assert decoded == word_library.decode(want, skip_special_tokens=False)


def test_plain_words_count_like_the_whole_text(word_library):
    for text in random_texts(500):
        found = words.plain_words(text)
        if found is not None:
            assert sum(len(ids_of(word_library, w)) for w in found) == len(ids_of(word_library, text))


def test_backtracking_steps_back():
    """The longest first match is not always in the encoding."""
    vocabulary = bpe_backtrack.load_vocabulary(WORD)
    rng = random.Random(3)
    taken = 0
    for _ in range(3000):
        word = "".join(rng.choice("aehilnorst") for _ in range(rng.randint(2, 14))) + bpe_backtrack.END
        got = vocabulary.encode_word(word)
        assert "".join(vocabulary.text[t] for t in got) == word
        longest = max(len(t) for t in vocabulary.ids if word.startswith(t)) if rng.random() < 0.01 else 0
        taken += longest > len(vocabulary.text[got[0]])
    assert taken > 0


def test_byte_ids_equal_the_library(byte_library):
    encode = byte_encoder(BYTE)
    for text in [*random_texts(2000), "<|endoftext|>", "a <|endoftext|> b", "\n\n  \n", "", "aaa" * 4000]:
        assert encode(text).tolist() == ids_of(byte_library, text)


def test_round_trip_digests(odd_docs, odd_rows, no_docs, word_library):
    def digest(id_, text):
        ids = ids_of(word_library, text)
        back = word_library.decode(ids, skip_special_tokens=False)
        listed = " ".join(map(str, ids))
        return (id_, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, back)))

    got = [tuple(r) for r in bpe_backtrack.round_trip_digests(odd_docs, WORD).collect()]
    assert sorted(got, key=str) == sorted((digest(*r) for r in odd_rows), key=str)
    assert bpe_backtrack.round_trip_digests(no_docs, WORD).count() == 0


def test_encode_then_decode(odd_docs, odd_rows, word_library):
    encoded = bpe_backtrack.encode_texts(odd_docs, WORD)
    texts = [tuple(r) for r in bpe_backtrack.decode_ids(encoded, WORD).collect()]
    want = [(i, word_library.decode(ids_of(word_library, t), skip_special_tokens=False)) for i, t in odd_rows]
    assert sorted(texts, key=str) == sorted(want, key=str)


def test_counts_and_their_cache(spark, odd_docs, odd_rows, no_docs, word_library, tmp_path):
    cache = str(tmp_path / "counts")
    want = sorted(
        ((i, len((t or "").encode()), n := len(ids_of(word_library, t)), n > 2048) for i, t in odd_rows), key=str
    )
    assert digest_cache.count_tokens(no_docs, WORD, cache).count() == 0
    for _ in range(2):
        got = digest_cache.count_tokens(odd_docs, WORD, cache).collect()
        assert sorted(map(tuple, got), key=str) == want
    folder = digest_cache.version_folder(cache, digest_cache.tokenizer_version(WORD))
    stored = spark.read.option("recursiveFileLookup", True).parquet(folder)
    distinct = {" ".join((t or "").split("\n")) for _, t in odd_rows}
    # Each content is encoded once, whatever its copies and runs.
    assert stored.count() == stored.dropDuplicates(["digest"]).count() <= len(distinct)


def test_only_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "counts")
    docs = spark.createDataFrame([(1, "known text")], "doc_id long, text string")
    folder = digest_cache.version_folder(cache, digest_cache.tokenizer_version(WORD))
    digest = hashlib.sha256(b"known text").digest()
    spark.createDataFrame([(bytearray(digest), 777)], digest_cache.CACHE_SCHEMA).write.parquet(folder)
    assert digest_cache.count_tokens(docs, WORD, cache).first()["n_tokens"] == 777


def test_many_special_strings_of_one_kind(word_library):
    encoder = bpe_backtrack.Encoder(WORD)
    text = "a <|startoftext|>" * 3000 + "b <|endoftext|> c<|startoftext|>"
    assert encoder.encode(text).tolist() == ids_of(word_library, text)


def test_digests_that_are_stored_twice_count_once(spark, tmp_path):
    cache = str(tmp_path / "counts")
    docs = spark.createDataFrame([(1, "some text"), (2, "some text"), (3, "other")], "doc_id long, text string")
    want = sorted(map(tuple, digest_cache.count_tokens(docs, WORD, cache).collect()))
    folder = digest_cache.version_folder(cache, digest_cache.tokenizer_version(WORD))
    # Two runs that overlapped have stored the same digests.
    digest_cache.stored_counts(spark, folder).write.parquet(f"{folder}/run=other")
    assert sorted(map(tuple, digest_cache.count_tokens(docs, WORD, cache).collect())) == want
    assert len(want) == 3


def test_the_query_keeps_its_counts(spark, monkeypatch):
    """A second run meets every count: it encodes nothing and gives equal rows."""
    sf_dir = "/root/testdata/sf0.001"
    once = sorted(map(tuple, queries.op4_digest_cache(spark, sf_dir).collect()))

    def refuse(path):
        def run(batches):
            assert not sum(b.num_rows for b in batches), "a stored text was encoded again"
            yield from ()

        return run

    monkeypatch.setattr(digest_cache, "count_batches", refuse)
    assert sorted(map(tuple, queries.op4_digest_cache(spark, sf_dir).collect())) == once


def test_pieces():
    assert piece_starts(1, 4, True) == piece_starts(4, 4, False) == [0]
    assert piece_starts(9, 4, True) == [0, 1, 5]
    assert piece_starts(8, 4, True) == piece_starts(8, 4, False) == [0, 4]
    assert piece_starts(9, 4, False) == [0, 4, 8]


def check_packing(rows, texts, library, capacity):
    """Every piece once, gapless sequences within the capacity; the number of sequences."""
    lengths = collections.Counter()
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        lengths[r["doc_id"]] += r["length"]
    want = collections.Counter()
    for i, t in texts:
        want[i] += len(ids_of(library, t)) + 1
    assert lengths == want
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return len(sequences)


@pytest.mark.parametrize("group_items", [200_000, 3])
def test_residual_packing(spark, odd_docs, odd_rows, no_docs, byte_library, group_items):
    rows = residual_packing.pack(odd_docs.repartition(5), BYTE, group_items=group_items).collect()
    n = check_packing(rows, odd_rows, byte_library, 2048)
    total = sum(len(ids_of(byte_library, t)) + 1 for _, t in odd_rows)
    assert n <= -(-total // 2048) + (1 if group_items > 3 else 3)
    long = sorted((r for r in rows if r["doc_id"] == 7), key=lambda r: r["piece"])
    ids = np.array([*ids_of(byte_library, "word " * 40_000), 0], "<u4")
    place = 0
    for k, r in enumerate(long):
        assert (r["piece"], r["start"]) == (k, place)
        assert r["ids_crc32"] == zlib.crc32(ids[place : place + r["length"]].tobytes())
        assert k == 0 or r["length"] == 2048
        place += r["length"]
    assert place == len(ids)
    assert residual_packing.pack(no_docs, BYTE).count() == 0


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(0, 60))]
        rooms, want = [], 0
        for size in sorted(sizes, reverse=True):
            fitting = [i for i, room in enumerate(rooms) if room >= size]
            if fitting:
                rooms[min(fitting, key=lambda i: rooms[i])] -= size
            else:
                rooms.append(50 - size)
        bin_of, offset = residual_packing.best_fit(np.array(sizes, np.int64), 50)
        assert len(set(bin_of.tolist())) == len(rooms)
        packer = bfd_matrices.Packer(50)
        full = [b for b in (packer.put(s, s) for s in sorted(sizes, reverse=True)) if b]
        held = [*full, *packer.rest()]
        assert sorted(50 - sum(b) for b in held) == sorted(rooms)


def test_capacity_tree():
    tree = bfd_matrices.CapacityTree(10)
    assert tree.tightest(0) == -1
    for room in (3, 3, 7, 10):
        tree.add(room, 1)
    assert [tree.tightest(s) for s in (0, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    tree.add(10, -1)
    assert tree.tightest(8) == -1


@pytest.mark.parametrize("shard_bytes", [32 << 20, 50_000])
def test_matrices_round_trip(spark, odd_docs, odd_rows, no_docs, byte_library, tmp_path, shard_bytes):
    path = str(tmp_path / "packed")
    bfd_matrices.write_matrices(odd_docs, BYTE, path, shard_bytes=shard_bytes)
    table = spark.read.parquet(path).toArrow()
    ids = bfd_matrices.load_matrix(table, "input_ids", "<u2")
    positions = bfd_matrices.load_matrix(table, "position_ids", "<u4")
    assert ids.shape == positions.shape == (table.num_rows, 2048)
    got = collections.Counter()
    parts = collections.defaultdict(list)
    for row, line, places in zip(table.to_pylist(), ids, positions, strict=True):
        ends = row["cu_seqlens"]
        assert ends[0] == 0 and ends[-1] == row["n_tokens"] <= 2048
        assert not line[ends[-1] :].any() and not places[ends[-1] :].any()
        for segment, a, b in zip(row["segments"], ends, ends[1:], strict=False):
            assert places[a:b].tolist() == list(range(b - a))
            parts[segment["id"]].append((segment["start"], line[a:b].tolist()))
    for id_, pieces in parts.items():
        got[id_, tuple(sorted((s, tuple(p)) for s, p in pieces))] += 1
    want = collections.defaultdict(list)
    for id_, text in odd_rows:
        whole = [*ids_of(byte_library, text), 50256]
        want[id_] += [(s, tuple(whole[s : s + 2048])) for s in range(0, len(whole), 2048)]
    assert got == {(id_, tuple(sorted(pieces))): 1 for id_, pieces in want.items()}
    assert len(set(table.column("sequence_id").to_pylist())) == table.num_rows
    assert bfd_matrices.pack_matrices(no_docs, BYTE).count() == 0
