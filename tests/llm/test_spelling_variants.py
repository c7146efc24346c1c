"""Spelling variants against all pairs of words compared in plain Python."""

import collections
import itertools
import random
import re
import zlib

import pytest
from featurespark.llm import queries, spelling_variants
from featurespark.llm.spelling_variants import Acceptor, one_edit_pairs


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def edits(word, letters):
    """All strings one edit from a word, each once."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b}
    found |= {a + c + b[1:] for a, b in cuts if b for c in letters}
    found |= {a + c + b for a, b in cuts for c in letters}
    return found - {word}


def test_plain_edits():
    words = ["".join(w) for n in range(4) for w in itertools.product("ab", repeat=n)]
    for w in words:
        assert {v for v in edits(w, "ab") if len(v) < 4} == {v for v in words if one_edit(w, v)}


def plain_words(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(rows):
    words = plain_words(rows)
    letters = sorted({c for w in words for c in w})
    near = {w: [v for v in edits(w, letters) if v in words] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def rows_of(df):
    found = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len({r["word"] for r in found})
    return {tuple(r) for r in found}


def misspelt(n, seed, letters):
    """Texts with words of few letters, many of them one edit apart, in both cases."""
    rng, rows = random.Random(seed), []
    stems = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(n)]
    for i in range(60):
        words = []
        for _ in range(400):
            word = stems[int(rng.random() ** 3 * n)]
            if rng.random() < 0.4:
                place = rng.randrange(len(word) + 1)
                word = word[:place] + rng.choice([*letters, ""]) + word[place + rng.randrange(2) :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i if i % 7 else None, rng.choice([" ", "-", "1"]).join(words)))
    return rows


@pytest.mark.parametrize(("letters", "part_words"), [("abé", 20_000), ("abé", 5), ("abcdeÀü", 30)])
def test_equals_all_pairs(spark, letters, part_words):
    rows = misspelt(120, 4, letters)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(spelling_variants.spelling_variants(docs, part_words=part_words)) == want


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    assert rows_of(spelling_variants.spelling_variants(odd_docs)) == brute(odd_rows)
    assert spelling_variants.spelling_variants(no_docs).count() == 0
    # Runs longer than words, and a table in which every row is the same.
    long = [(1, f"{'x' * 600} {'x' * 601} {'ab' * 300}y"), (1, None), (1, "same words")]
    assert rows_of(
        spelling_variants.spelling_variants(spark.createDataFrame(long * 3, "doc_id long, text string"))
    ) == brute(long * 3)


def test_pairs_of_the_composition():
    rng = random.Random(1)
    for _ in range(300):
        pool = {"".join(rng.choices("abc", k=rng.randint(3, 4))) for _ in range(rng.randint(1, 40))}
        same, longer = (sorted(w for w in pool if len(w) == k) for k in (3, 4))
        found = list(one_edit_pairs(same, longer))
        assert len(found) == len(set(found))
        want = {(a, b) for a, b in itertools.combinations(same, 2) if one_edit(a, b)}
        want |= {(a, b) for a in same for b in longer if one_edit(a, b)}
        assert {tuple(sorted(p, key=lambda w: (len(w), w))) for p in found} == want


def test_the_acceptor_is_minimal():
    acceptor = Acceptor()
    start = acceptor.add(["tap", "taps", "top", "tops"])
    # Behind t both a and o lead to one state.
    after_t = acceptor.arcs[acceptor.arcs[start]["t"]]
    assert after_t["a"] == after_t["o"]
    assert len(acceptor.arcs) == 5
    assert sorted(acceptor.common(start, start)) == ["tap", "taps", "top", "tops"]


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(queries.op12_spelling_variants(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_very_long_words_are_compared_whole(spark):
    rows = [(i, f"{'x' * 20_000} {'ab' * 9000}c") for i in range(9)]
    rows += [(100 + i, f"{'x' * 20_001} {'ab' * 4000}b{'ab' * 5000}c") for i in range(4)]
    found = spelling_variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_words(rows)
    assert {r["word"]: r["n"] for r in found} == want
    for r in found:
        near = [w for w in want if abs(len(w) - len(r["word"])) < 2 and w != r["word"] and one_edit(w, r["word"])]
        assert r["n_near"] == len(near) > 0
