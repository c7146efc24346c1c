import numpy as np
import pytest
from featurespark.operators import knn, ml


def brute(vectors, ids, labels, k, exclude_self, normalize):
    v = np.array(vectors, dtype=float)
    if normalize:
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        v = np.where(norm == 0, v, v / np.where(norm == 0, 1, norm))
    out = {}
    for i, own in enumerate(ids):
        d = np.round(np.sqrt(((v - v[i]) ** 2).sum(axis=1)), 9)
        near = sorted((d[j], ids[j], labels[j]) for j in range(len(ids)) if not (exclude_self and j == i))
        out[own] = near[:k]
    return out


def frame(spark, vectors, ids, labels):
    rows = [(i, [float(x) for x in v], label) for i, v, label in zip(ids, vectors, labels)]
    return spark.createDataFrame(rows, "id long, v array<double>, label int")


@pytest.fixture(scope="module")
def clustered():
    """Clusters, and a third of all rows copies of one vector."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 3)) * 10
    vectors = [list(centres[i % 5] + rng.normal(size=3)) for i in range(160)]
    vectors += [[1.0, 1.0, 1.0]] * 78 + [[0.0, 0.0, 0.0]] * 2
    labels = [int(x) for x in rng.integers(0, 4, size=240)]
    return vectors, list(range(240)), labels


@pytest.mark.parametrize("exclude_self", [True, False])
@pytest.mark.parametrize(("normalize", "block_rows", "pivots"), [(True, 16_384, None), (False, 11, 9)])
def test_equals_brute_force(spark, clustered, exclude_self, normalize, block_rows, pivots):
    vectors, ids, labels = clustered
    got = knn.nearest_neighbours(
        frame(spark, *clustered),
        "id",
        "v",
        "label",
        k=5,
        exclude_self=exclude_self,
        normalize=normalize,
        block_rows=block_rows,
        n_pivots=pivots,
    ).collect()
    want = brute(vectors, ids, labels, 5, exclude_self, normalize)
    assert len(got) == len(ids)
    for r in got:
        near = [(n["distance"], n["id"], n["label"]) for n in r["neighbours"]]
        assert [n[1:] for n in near] == [n[1:] for n in want[r["id"]]], r["id"]
        assert [n[0] for n in near] == pytest.approx([n[0] for n in want[r["id"]]], abs=2e-9)


def test_projections_find_most_neighbours(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * 4
    vectors = [list(centres[i % 40] + rng.normal(size=16)) for i in range(1200)] + [[0.0] * 16] * 30
    ids, labels = list(range(1230)), [0] * 1230
    want = brute(vectors, ids, labels, 5, True, False)
    options = dict(k=5, exclude_self=True, normalize=False, block_rows=200)
    df = frame(spark, vectors, ids, labels)
    found = {}
    for how in (knn.Projections(), knn.Projections(tables=1, projections=8)):
        got = knn.nearest_neighbours(df, "id", "v", "label", approximate=how, **options).collect()
        assert len(got) == len(ids)
        hits = sum(len({n["id"] for n in r["neighbours"]} & {n[1] for n in want[r["id"]]}) for r in got)
        found[how.tables] = hits / (5 * len(ids))
        assert all(len({n["id"] for n in r["neighbours"]}) == len(r["neighbours"]) for r in got)
    assert found[12] >= 0.9 > found[1]


def test_in_sample_rows_predict_their_own_label(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(30, 4)).tolist()
    labels = [i % 3 for i in range(30)]
    df = frame(spark, vectors, list(range(30)), labels)
    got = knn.knn_classify(df, "id", "v", "label").collect()
    assert all(r["label"] == r["predicted"] for r in got)


def test_votes(spark):
    # Neighbours of id 0 at distances 1 (label 2), 2 (label 1) and 2 (label 1): a tie.
    vectors = [[0.0], [1.0], [2.0], [-2.0]]
    df = frame(spark, vectors, [0, 1, 2, 3], [9, 2, 1, 1])
    options = dict(k=3, exclude_self=True, normalize=False)
    got = {r["id"]: r["predicted"] for r in knn.knn_classify(df, "id", "v", "label", **options).collect()}
    assert got[0] == 1
    proba = knn.knn_probabilities(df, "id", "v", "label", **options).collect()
    assert {r["class"]: r["probability"] for r in proba if r["id"] == 0} == {1: 0.5, 2: 0.5}


def test_fewer_rows_than_neighbours(spark):
    df = frame(spark, [[0.0], [1.0]], [0, 1], [5, 6])
    got = knn.nearest_neighbours(df, "id", "v", "label", exclude_self=True, normalize=False).collect()
    assert {r["id"]: len(r["neighbours"]) for r in got} == {0: 1, 1: 1}


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, v array<double>, label int")
    assert knn.knn_classify(df, "id", "v", "label").count() == 0


def test_normalizer_agrees_with_array_form(spark):
    df = frame(spark, [[3.0, 4.0], [0.0, 0.0]], [0, 1], [0, 0])
    got = [r["unit"] for r in ml.normalize_rows(df, "v").orderBy("id").collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]


def test_forest(spark):
    rows = [(i, float(i % 2), float(i), "ab"[i % 2], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, x double, z double, label string, flag int")
    scored = ml.forest_classify(df, ["x", "z"], "label", ["k"], num_trees=5, max_depth=4).collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in scored)
    assert sum(r["label"] == r["predicted"] for r in scored) > 50
    for is_boolean in (True, False):
        weights = ml.forest_importance(df, ["x", "z"], "flag", is_boolean, 5, 4).collect()
        assert sum(r["importance"] for r in weights) == pytest.approx(1.0)


def test_tokens(spark):
    rows = [(1, 2, 3), (2, None, 3), (4, 1, 0), (None, 1, 2)]
    df = spark.createDataFrame(rows, "batter int, sum_hits int, sum_bats int")
    tokens = ml.metric_tokens(df)
    assert [r["tokens"] for r in tokens.collect()] == [["1", "0.667"], ["2", ""], ["4", ""], ["", "0.5"]]
    counts = ml.term_counts(tokens.fillna(0, ["batter"]), "tokens", "batter").collect()
    assert sorted(tuple(r) for r in counts) == [
        (0, "", 1.0), (0, "0.5", 1.0), (1, "0.667", 1.0), (1, "1", 1.0),
        (2, "", 1.0), (2, "2", 1.0), (4, "", 1.0), (4, "4", 1.0),
    ]


def test_null_token_arrays_are_empty(spark):
    df = spark.createDataFrame([(1, ["a", "a"]), (2, None)], "k int, t array<string>")
    assert [tuple(r) for r in ml.vocabulary(df, "t").collect()] == [(0, "a", 2)]
    assert [tuple(r) for r in ml.term_counts(df, "t", "k").collect()] == [(1, "a", 2.0)]


def test_no_token_is_lost(spark):
    n = 300_000
    df = spark.range(n).selectExpr("id % 7 AS k", "array(CAST(id AS STRING)) AS t")
    assert ml.term_counts(df, "t", "k").count() == n
    words = ml.vocabulary(df.union(df.where("k = 3")), "t")
    known = words.select("index", "n").distinct().selectExpr("COUNT(*)", "MIN(index)", "MAX(index)").first()
    assert tuple(known) == (n, 0, n - 1)
    # Tokens that occur twice come first, in their own order.
    first = [r["token"] for r in words.orderBy("index").limit(4).collect()]
    assert first == sorted(str(i) for i in range(n) if i % 7 == 3)[:4]
    vectors = ml.count_vectors(df, "t", "k", words)
    assert vectors.count() == n
    rows = ml.sparse_rows(vectors.where("index < 50000"), "k").collect()
    assert len(rows) < 7 or all(r["indices"] == sorted(r["indices"]) for r in rows)
    assert sum(len(r["counts"]) for r in rows) == 50_000


@pytest.mark.parametrize("at", [0, 40])
@pytest.mark.parametrize("bad", [[float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0]])
def test_vectors_that_are_no_numbers(spark, at, bad):
    """Whatever its id, and so its place among the pivots, a bad vector leaves the others alone."""
    good = [i for i in range(41) if i != at]
    vectors = [[float(i), float(i * i % 7)] for i in good]
    rows = list(zip(good, vectors, [i % 3 for i in good], strict=True)) + [(at, bad, 0)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    got = {
        r["id"]: [(n["distance"], n["id"], n["label"]) for n in r["neighbours"]]
        for r in knn.nearest_neighbours(df, "id", "v", "label", 3, normalize=False, block_rows=8).collect()
    }
    assert got.pop(at) == []
    assert got == brute(vectors, good, [i % 3 for i in good], 3, False, False)


def test_forest_depends_on_its_rows_only(spark):
    rows = [(float(i % 13), float(i * 7 % 31), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, z double, flag int")
    shuffled = spark.createDataFrame(rows[::-1], df.schema)
    found = [
        ml.forest_importance(d, ["x", "z"], "flag", True, 5, 4).collect()
        for d in (df.repartition(2), shuffled.repartition(7))
    ]
    assert found[0] == found[1]


def test_forest_refuses_missing_values(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (2.0, "b")], "x double, label string")
    with pytest.raises(Exception, match="(?i)null|NaN"):
        ml.forest_classify(df, ["x"], "label", num_trees=2, max_depth=2).collect()


def test_rows_with_missing_values_stay(spark):
    df = spark.createDataFrame([(3.0, 4.0), (None, 1.0), (0.0, 0.0)], "x double, y double")
    got = [r["unit"] for r in ml.normalize_rows(df, ["x", "y"]).collect()]
    assert sorted(got, key=str) == [None, [0.0, 0.0], [0.6, 0.8]] or None in got and len(got) == 3


def test_small_blocks_copy_no_row_ever_more_often(spark, monkeypatch):
    """A hundred blocks a side would copy every vector a hundred times; routed vectors are not written."""
    sides, written = [], []
    bounded, materialize = knn.bounded_side, knn.materialize
    monkeypatch.setattr(knn, "bounded_side", lambda df: sides.append(bounded(df)) or sides[-1])
    monkeypatch.setattr(knn, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(400, 3)).tolist()
    df = frame(spark, vectors, list(range(400)), [0] * 400)
    found = knn.nearest_neighbours(df, "id", "v", "label", 3, normalize=False, block_rows=4, n_pivots=2)
    pairs = sides[0].selectExpr("SUM(ref_blocks * query_blocks)").first()[0]
    assert pairs <= 2 * (knn.MANY_BLOCKS + 1) ** 2
    assert "knn-visits" not in written
    want = brute(vectors, list(range(400)), [0] * 400, 3, False, False)
    got = {r["id"]: [(n["id"], n["label"]) for n in r["neighbours"]] for r in found.collect()}
    assert got == {i: [n[1:] for n in near] for i, near in want.items()}


@pytest.mark.parametrize("kind", ["plain", "far", "grid", "huge", "tiny", "alike", "ordered"])
def test_block_neighbours_are_exact(kind):
    rng = np.random.default_rng(3)
    refs = rng.normal(size=(2500, 5))
    if kind == "far":
        refs = refs + 1e7
    elif kind == "grid":
        refs = rng.integers(0, 3, size=(2500, 5)).astype(float)
    elif kind == "huge":
        refs = refs * 1e180
    elif kind == "tiny":
        refs = refs * 1e-7
    elif kind == "alike":
        refs = np.ones((2500, 5))
    elif kind == "ordered":
        refs = refs * 0.01 + np.arange(2500)[:, None] // 100
    queries = refs[::40]
    with np.errstate(over="ignore"):
        d = np.round(np.sqrt(np.square(queries[:, None] - refs[None]).sum(2)), 9)
    order = np.argsort(d, axis=1, kind="stable")[:, :6]
    q, r, got = knn._References(refs).nearest(6, queries)
    assert q.tolist() == np.repeat(np.arange(len(queries)), 6).tolist()
    assert r.tolist() == order.ravel().tolist()
    assert got.tolist() == np.take_along_axis(d, order, 1).ravel().tolist()
