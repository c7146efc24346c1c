"""Exact and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from featurespark.llm import content_sort, gray_simhash
from featurespark.llm.components import component_roots


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def groups(texts, keep):
    """The rows that ``content_groups`` should give."""
    ids = collections.defaultdict(list)
    for id_, text in texts:
        ids[lower(text)].append(id_)
    out = []
    for text, members in ids.items():
        known = [i for i in members if i is not None]
        best = keep(known) if known else None
        taken = False
        for i in members:
            kept = i == best and not taken
            taken |= kept
            out.append((i, best, len(members), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("keep", "pick"), [("largest", max), ("smallest", min)])
@pytest.mark.parametrize("hot_rows", [1000, 1])
def test_content_groups(odd_docs, odd_rows, keep, pick, hot_rows):
    rows = odd_docs.repartition(4)
    got = content_sort.content_groups(rows, keep=keep, hot_rows=hot_rows).collect()
    assert sorted(map(tuple, got), key=str) == groups(odd_rows, pick)


def test_hot_text_is_counted_before_it_moves(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Copy', CONCAT('t', id)) AS text")
    rows = content_sort.content_groups(docs, keep="largest").where("group_size > 1")
    assert rows.select("keep_id", "group_size").distinct().collect() == [(3999, 1334)]
    assert rows.where("kept").count() == 1


def test_texts_with_one_beginning(spark):
    """Splitters hold beginnings only; whole texts decide."""
    docs = spark.range(300).selectExpr("id AS doc_id", "CONCAT(REPEAT('same ', 40), id % 100) AS text")
    got = content_sort.content_groups(docs).groupBy("group_size").count().collect()
    assert [tuple(r) for r in got] == [(3, 300)]


def test_drop_duplicates(odd_docs, no_docs, odd_rows):
    kept = content_sort.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == len({lower(t) for _, t in odd_rows})
    assert content_sort.drop_duplicates(no_docs).count() == 0
    assert content_sort.content_groups(no_docs).count() == 0
    with pytest.raises(ValueError, match="smallest"):
        content_sort.content_groups(odd_docs, keep="first")


def test_main_path_is_native(odd_docs):
    plan = content_sort.content_groups(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Near duplicates


def plain_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, radius):
    """For each distinct value the smallest one it reaches, by comparing all pairs."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    root = np.arange(len(values))
    while True:
        lowest = np.array([root[row].min() for row in near])
        if (lowest == root).all():
            return root
        root = lowest


def test_fingerprints(odd_rows):
    texts = [t or "" for _, t in odd_rows] + ["ab Cd\x1cé x  Y\tz", "A b", "a B c d", "Ä ä Ö"]
    for text in texts:
        for width in (4, 5):
            assert gray_simhash.fingerprint(text, width) == plain_fingerprint(text[:3000], width) or len(text) > 3000


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 977}x{i}" for i in range(3000))
    whole = gray_simhash.fingerprint(text, 4)
    monkeypatch.setattr(gray_simhash, "SHINGLES_AT_ONCE", 700)
    assert gray_simhash.fingerprint(text, 4) == whole == plain_fingerprint(text, 4)


def clusters(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, n // 20, dtype=np.uint64)
    values = []
    for _ in range(n):
        value = centres[rng.integers(0, len(centres))]
        for bit in rng.integers(0, 64, rng.integers(0, 9)):
            value ^= np.uint64(1) << np.uint64(bit)
        values.append(value)
    return np.unique(np.array(values, np.uint64))


@pytest.mark.parametrize("radius", [0, 2, 4])
@pytest.mark.parametrize("pairs", [16, 4096])
def test_index_finds_what_all_pairs_find(monkeypatch, radius, pairs):
    monkeypatch.setattr(gray_simhash, "PAIRS_AT_ONCE", pairs)
    values = clusters(600, radius)
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    order = np.argsort(rank)
    got = gray_simhash.linked_labels(values[order], np.zeros(len(values), int), order, radius)
    assert (got == linked(values, radius)).all()


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_masks_cover_every_near_pair(blocks):
    masks = [m & (2**64 - 1) for m in gray_simhash.block_masks(4, 0, blocks)]
    rng = np.random.default_rng(2)
    for _ in range(200):
        change = sum(1 << int(b) for b in set(rng.integers(0, 64, 4).tolist()))
        assert any(change & m == 0 for m in masks)


def test_more_rows_take_more_blocks():
    sizes = [len(gray_simhash.block_masks(4, 10**k)) for k in (3, 6, 8, 10, 12)]
    assert sizes == sorted(sizes) and sizes[0] == 5 < sizes[-1]


@pytest.mark.parametrize("options", [{}, {"part_rows": 10}, {"blocks": 7}])
def test_links_connect_the_same_groups(spark, options):
    options = dict(options)
    values = clusters(400, 9)
    signed = [(int(v),) for v in values.view(np.int64)]
    single = spark.createDataFrame(signed, "fp long")
    masks = gray_simhash.block_masks(4, len(signed), options.pop("blocks", None))
    found = gray_simhash.links(single, masks, 4, **options).collect()
    root = {int(v): int(v) for v in values.view(np.int64)}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[top(a)] = top(b)
    got = collections.Counter(collections.Counter(top(x) for x in root).values())
    assert got == collections.Counter(collections.Counter(linked(values, 4).tolist()).values())


def test_near_components(spark, odd_docs, odd_rows, no_docs):
    want = {}
    prints = {t: plain_fingerprint(t, 4) for _, t in odd_rows if len(t or "") < 3000}
    got = gray_simhash.near_components(odd_docs).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        want.setdefault(r["fingerprint"], set()).add(r["component_id"])
    assert all(len(ids) == 1 for ids in want.values())
    assert want["0" * 16] == {4}
    shown = {f"{v:016x}" for v in prints.values()}
    assert shown <= set(want)
    assert gray_simhash.near_components(no_docs).count() == 0


def test_near_duplicates_go(spark, odd_docs, odd_rows, no_docs):
    kept = gray_simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    # 1, 2 and 3 are equal but for case, 4 to 6 have no words; the rows without an id have copies.
    assert sorted(ids) == [-5, 1, 4, 7, 8, 9, 10]
    assert gray_simhash.drop_near_duplicates(no_docs).count() == 0
    alone = odd_docs.where("doc_id IS NULL AND text IS NOT NULL")
    assert [r["doc_id"] for r in gray_simhash.drop_near_duplicates(alone).collect()] == [None]


def brute_kept(rows, radius=4):
    """The smallest id of each group that close fingerprints connect."""
    values = np.array([plain_fingerprint(text, 4) for _, text in rows], np.uint64)
    groups = collections.defaultdict(list)
    for label, (i, _) in zip(linked(values, radius).tolist(), rows, strict=True):
        groups[label].append(i)
    return {min(ids) for ids in groups.values()}


def edited(n, seed, length=300):
    """Documents, each followed by copies with ever more words changed."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(length)]
        out.append(" ".join(words))
        for edits in (1, 2, 3, 40):
            copy = list(words)
            for place in rng.sample(range(length), edits):
                copy[place] = "changed"
            out.append(" ".join(copy))
    return [(-i, text) for i, text in enumerate(out)]


@pytest.mark.parametrize("options", [{}, {"part_rows": 50}, {"blocks": 7}])
def test_one_document_of_each_group_stays(spark, options):
    rows = edited(40, 8)
    want = brute_kept(rows)
    assert 40 < len(want) < 180
    # Names the operator uses inside, as further columns.
    extra = ", ".join(f"{n} int" for n in ("row", "place", "fp", "root", "best", "kept", "id", "no_id"))
    docs = spark.createDataFrame([(*r, *range(8)) for r in rows], f"doc_id long, text string, {extra}")
    kept = gray_simhash.drop_near_duplicates(docs, **options)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == want


def test_a_large_group_leaves_one(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for i in range(200):
        copy = list(words)
        copy[rng.randrange(2000)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = gray_simhash.drop_near_duplicates(docs, part_rows=50)
    assert {r["doc_id"] for r in kept.collect()} == brute_kept(rows)


def test_component_roots(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 201), (200, 202)]
    roots = {a: b for a, b in component_roots(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {101: 100, 201: 200, 202: 200}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0
