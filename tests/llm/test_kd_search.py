"""Exact top-k against all pairs, and the trees themselves."""

import math

import numpy as np
import pytest
from featurespark.llm import kd_search


def brute(rows, k, every, scale=64):
    whole = {}
    for id_, v in rows:
        if id_ is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole[id_, tuple(math.floor(scale * x) for x in v)] = None
    out = []
    for own, q in whole:
        if own % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != own and len(v) == len(q)]
        out += [(own, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(
        [(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, id string, shard string"
    )
    return sorted(map(tuple, kd_search.top_k(df, **options).collect()))


@pytest.mark.parametrize(("shard_rows", "leaf_rows"), [(8192, 256), (40, 4), (100, 1)])
def test_equals_all_pairs(spark, shard_rows, leaf_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=5)).tolist()) for i in range(400)]
    # A third of all rows are copies, which tie everywhere.
    rows += [(400 + i, [0.5, 0.25, 0.0, -0.5, 1.0]) for i in range(200)]
    options = {"k": 7, "every": 10, "shard_rows": shard_rows, "leaf_rows": leaf_rows}
    assert run(spark, rows, **options) == brute(rows, 7, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, [-1.0, 0.01]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None),
        (4, [None, 1.0]), (None, [5.0, 5.0]), (60, [1.0]), (61, [2.0]), (80, []), (81, []), (0, [1.0, 2.0]),
        (20, [3.0, 3.0]), (-20, [2.0, 2.0]),
    ]
    assert run(spark, rows) == brute(rows, 20, 20)
    assert run(spark, []) == []
    assert run(spark, [(3, None), (0, [nan])]) == []


def test_fewer_rows_than_k(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    assert run(spark, rows, k=20, every=1) == brute(rows, 20, 1)


def test_products_beyond_doubles(spark):
    rows = [(i, [2.0**24 + i, 2.0**23 - i, 1.0]) for i in range(30)]
    assert run(spark, rows, k=3, every=5) == brute(rows, 3, 5)


def test_boxes_are_tight_and_halved():
    rng = np.random.default_rng(5)
    points = rng.integers(-50, 50, (1000, 4))
    tree = kd_search.Tree.build(np.arange(1000), points, 16)
    for low, high, (left, right), (start, end) in zip(tree.low, tree.high, tree.children, tree.spans):
        inside = tree.vectors[start:end]
        assert (inside.min(axis=0) == low).all() and (inside.max(axis=0) == high).all()
        assert left >= 0 or end - start <= 16
        if left >= 0:
            sizes = [int(np.diff(tree.spans[c])[0]) for c in (left, right)]
            assert abs(sizes[0] - sizes[1]) <= 1
    again = kd_search.Tree.from_row(tree.to_row(3))
    assert (again.vectors == tree.vectors).all() and (again.low == tree.low).all()


def test_a_floor_prunes_boxes():
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.integers(0, 5, (500, 2)), rng.integers(90, 100, (500, 2))])
    tree = kd_search.Tree.build(np.arange(1, 1001), points, 25)
    opened = []

    class Spy(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                opened.append(key)
            return super().__getitem__(key)

    tree.ids = tree.ids.view(Spy)
    query = np.array([[1, 1]])
    best = tree.search(np.array([0]), query, [190], 3)[0]
    assert all(score >= 190 for score, _ in best)
    assert 0 < len(opened) <= 20
