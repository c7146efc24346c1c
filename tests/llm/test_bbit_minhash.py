"""b-bit MinHash components against all pairs compared in plain Python."""

import collections
import random
import re

import numpy as np
import pytest
from featurespark.llm import bbit_minhash, queries


def plain_set(text, width=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return set()
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, percent=85):
    """(id, size, component) of every row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {r: min((i for i in found if i is not None), default=None) for r, found in ids.items()}
    found = ((rows[i][0], len(x), least[find(i)] if x else rows[i][0]) for i, x in enumerate(sets))
    return collections.Counter((*r, r[0] == r[2]) for r in found)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def changed(words, places, rng):
    return [f"x{rng.randint(0, 10**6)}" if i in places else w for i, w in enumerate(words)]


def near_the_limit(n, seed):
    """Texts with copies on both sides of the threshold, ids falling."""
    rng, texts = random.Random(seed), []
    for _ in range(n):
        length = rng.choice((4, 8, 15, 30, 60, 150))
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(length)]
        texts.append(words)
        for _ in range(rng.choice((0, 1, 4))):
            edits = rng.randint(0, max(1, length // 25))
            texts.append(changed(words, set(rng.sample(range(length), edits)), rng))
    return [(len(texts) - i, " ".join(words)) for i, words in enumerate(texts)]


def test_odd_documents(odd_docs, odd_rows, no_docs):
    assert rows_of(bbit_minhash.near_components(odd_docs)) == brute(odd_rows)
    assert bbit_minhash.near_components(no_docs).count() == 0


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 3, "chunk_bytes": 8000}])
def test_components_equal_all_pairs(spark, options):
    rows = near_the_limit(150, 3)
    # A large group of copies around one text, chains of it, and a passage that many texts share.
    rng = random.Random(5)
    words = [f"v{i}" for i in range(120)]
    rows += [(1000 + i, " ".join(changed(words, set(rng.sample(range(120), i % 4)), rng))) for i in range(80)]
    passage = [f"p{i}" for i in range(90)]
    for i in range(60):
        own = [f"o{rng.randint(0, 10**6)}" for _ in range(4 + i % 9)]
        rows.append((2000 + i, " ".join(own + passage)))
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(bbit_minhash.near_components(docs, **options)) == want


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for jaccard in (0.3, 0.7, 0.85, 0.95):
        for _ in range(60):
            pool = rng.integers(0, 2**64, 600, dtype=np.uint64)
            shared = round(600 * jaccard)
            half = shared + (600 - shared) // 2
            a, b = pool[:half], np.append(pool[:shared], pool[half:])
            least = np.stack([bbit_minhash.minima(a), bbit_minhash.minima(b)])
            sig = bbit_minhash.packed(least)
            equal = sum(
                (int(x) >> s) % 16 == (int(y) >> s) % 16
                for x, y in zip(*sig, strict=True)
                for s in range(0, 64, 4)
            )
            found = (equal / 192 - 1 / 16) / (15 / 16)
            deviation = (jaccard * (1 - jaccard) / 192) ** 0.5 + 0.015
            errors.append((found - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) / deviation)
    assert abs(np.mean(errors)) < 0.2
    assert np.max(np.abs(errors)) < 4.5


def test_links_span_what_all_pairs_connect():
    rng = random.Random(7)
    words = [f"v{i}" for i in range(150)]
    rows = [(i, " ".join(changed(words, set(rng.sample(range(150), i % 9)), rng))) for i in range(200)]
    hashes = [bbit_minhash.shingle_set(t, 3) for _, t in rows]
    sig = bbit_minhash.packed(np.stack([bbit_minhash.minima(h) for h in hashes]))
    lists = bbit_minhash.pa.array([h.view(np.int64) for h in hashes])
    n = np.array([len(h) for h in hashes])
    links = bbit_minhash.spanning_links(sig, n, bbit_minhash.Sets(lists, 85), 85)
    sets = [plain_set(t) for _, t in rows]
    assert all(100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for a, b in links)
    apart = len({r[2] for r in brute(rows)})
    assert 1 < apart < 150
    assert len(links) == len(rows) - apart


def test_the_packed_count_is_the_counted_one(spark):
    rng = np.random.default_rng(2)
    least = rng.integers(0, 40, (2, bbit_minhash.MINIMA), dtype=np.uint32)
    a, b = bbit_minhash.packed(least).view(np.int64).tolist()
    row = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    want = int((least[0] % 16 == least[1] % 16).sum())
    assert row.select(bbit_minhash.equal_fields("a", "b")).first()[0] == want


def test_whole_table_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows_of(queries.op11_bbit_minhash(spark, "/root/testdata/sf0.001")) == brute(rows)
