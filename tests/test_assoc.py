import math
import random

import numpy as np
import pytest
from featurespark.operators import assoc, gram
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest


def scores(df):
    return {(r["predictor1"], r["predictor2"]): r["score"] for r in df.collect()}


@pytest.fixture(scope="module")
def two_by_two(spark):
    counts = {("a", "p"): 10, ("a", "q"): 20, ("b", "p"): 30, ("b", "q"): 5}
    rows = [cell for cell, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "x string, y string")


def test_correlation_ratio(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 6.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    assert scores(assoc.correlation_ratio(df, ["x"], ["g"])) == {("x", "g"): 0.85424}
    rows = [("a", 1.0), ("a", 3.0), ("b", 2.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    assert scores(assoc.correlation_ratio(df, ["x"], ["g"])) == {("x", "g"): 0.0}


def plain_r(x, y):
    both = [(a, b) for a, b in zip(x, y, strict=True) if a is not None and b is not None and a == a and b == b]
    if not both:
        return None
    a, b = np.array(both, float).T
    if a.std() <= 1e-9 * abs(a.mean()) or b.std() <= 1e-9 * abs(b.mean()):
        return None
    return float(((a - a.mean()) * (b - b.mean())).mean() / (a.std() * b.std()))


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(3)
    columns = []
    for k in range(130):
        values = (rng.normal(size=300) + (columns[k - 7] if k % 7 == 6 and k > 7 else 0)) * 10.0 ** (k % 9)
        columns.append(values + (1e7 if k % 11 == 0 else 0))
    table = [[None if rng.random() < 0.1 * (k % 3) else v for v in c.tolist()] for k, c in enumerate(columns)]
    table[5] = [0.1] * 300
    # Constant where its partner has a value.
    table[6] = [3.7 if i % 2 else float(i) for i in range(300)]
    table[7] = [float(i) if i % 2 else None for i in range(300)]
    table[8] = [float("nan")] * 300
    table[9] = [1.0, *[None] * 299]
    names = [f"c.{k}" for k in range(130)]
    df = spark.createDataFrame(list(zip(*table, strict=True)), ", ".join(f"`{n}` double" for n in names))
    found = assoc.corr_pairs(df.repartition(7), names, simplify=True, digits=None)
    got = scores(found)
    assert len(got) == 130 * 131 // 2
    for (a, b), r in got.items():
        want = plain_r(table[names.index(a)], table[names.index(b)])
        if want is None:
            assert r is None, (a, b, r)
        else:
            assert r == pytest.approx(want, abs=1e-7), (a, b)


def test_correlations_scan_once(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    many = lines.selectExpr(*(f"l_quantity * {k} + l_tax AS q{k}" for k in range(1, 151)))
    plan = assoc.corr_pairs(many, many.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert len(scores(assoc.corr_pairs(many.limit(0), many.columns[:3]))) == 9


def test_moments_merge_like_one_table():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6)) * 10.0 ** np.arange(6) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    whole = gram.Moments(6)
    whole.add(x)
    held = None
    for part in np.split(x, [0, 1, 40, 41, 300]):
        moments = gram.Moments(6)
        moments.add(part)
        held = moments.central() if held is None else gram.merge(held, moments.central())
    assert np.allclose(gram.pearson(held), gram.pearson(whole.central()), atol=1e-9)


def test_chi_square_and_yates(two_by_two):
    plain = assoc.chi_square(two_by_two, [("x", "y")]).first()["chi2"]
    assert plain == pytest.approx(18.726190, abs=1e-6)
    yates = assoc.chi_square(two_by_two, [("x", "y")], yates=True).first()["chi2"]
    assert yates == pytest.approx(16.578482, abs=1e-6)


def test_v_and_t(two_by_two):
    v = scores(assoc.cramers_v(two_by_two, ["x", "y"]))
    t = scores(assoc.tschuprows_t(two_by_two, ["x", "y"]))
    assert v["x", "y"] == pytest.approx(0.526113, abs=1e-6)
    assert t["x", "y"] == pytest.approx(0.526113, abs=1e-6)
    plain = scores(assoc.cramers_v(two_by_two, ["x", "y"], bias_correction=False))
    assert plain["x", "y"] == pytest.approx(0.505028, abs=1e-6)


def test_one_category(spark):
    df = spark.createDataFrame([("a", "p"), ("a", "q")], "x string, y string")
    assert scores(assoc.cramers_v(df, ["x", "y"]))["x", "y"] is None
    assert scores(assoc.tschuprows_t(df, ["x", "y"], bias_correction=False))["x", "y"] is None


def test_empty_cells_and_nulls(spark):
    # A 2 x 2 table with an empty cell; the null is a category of its own.
    rows = [("a", None)] * 6 + [("a", "q")] * 2 + [("b", "q")] * 4
    df = spark.createDataFrame(rows, "x string, y string")
    got = assoc.chi_square(df, [("x", "y")]).first()
    assert (got["n"], got["r"], got["c"]) == (12, 2, 2)
    assert got["chi2"] == pytest.approx(6.0)
    yates = assoc.chi_square(df, [("x", "y")], yates=True).first()["chi2"]
    assert yates == pytest.approx(3.375)


def test_agrees_with_mllib(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice("pqrs")) for _ in range(300)]
    df = spark.createDataFrame(rows, "x string, y string")
    for c in ("x", "y"):
        df = StringIndexer(inputCol=c, outputCol=f"{c}_i").fit(df).transform(df)
    data = VectorAssembler(inputCols=["x_i"], outputCol="v").transform(df)
    want = ChiSquareTest.test(data, "v", "y_i").first()["statistics"][0]
    assert assoc.chi_square(df, [("x", "y")]).first()["chi2"] == pytest.approx(want)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 4.0)], "x double, y double")
    got = scores(assoc.corr_pairs(df, ["x", "y"]))
    assert got == {("x", "x"): None, ("x", "y"): None, ("y", "x"): None, ("y", "y"): 1.0}


def test_no_columns(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    assert assoc.cramers_v(df, []).count() == 0
    assert assoc.correlation_ratio(df, ["x"], []).count() == 0
    assert assoc.corr_pairs(df, []).count() == 0


def test_more_pairs_than_one_pass(spark):
    columns = [f"c{i}" for i in range(12)]
    df = spark.range(50).selectExpr(
        *(f"CAST(id * {i + 1} % 7 AS STRING) AS c{i}" for i in range(12))
    )
    assert len(scores(assoc.cramers_v(df, columns))) == 78
    numbers = df.selectExpr(*(f"CAST({c} AS DOUBLE) AS {c}" for c in columns))
    got = scores(assoc.corr_pairs(numbers, columns))
    assert len(got) == 144
    assert all(got[a, b] == got[b, a] for a, b in got)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("pqr"), st.integers(-5, 5)), min_size=3, max_size=40))
def test_bounds_and_relabelling(spark, rows):
    df = spark.createDataFrame([(x, y, float(z)) for x, y, z in rows], "x string, y string, z double")
    renamed = df.replace({"a": "d", "b": "c", "c": "b", "d": "a"}, subset=["x"])
    for measure, corrected in ((assoc.cramers_v, False), (assoc.tschuprows_t, True)):
        got = scores(measure(df, ["x", "y"], corrected))
        again = scores(measure(renamed, ["x", "y"], corrected))
        for pair, score in got.items():
            if score is None:
                assert again[pair] is None
            else:
                assert score == pytest.approx(again[pair]) and math.isfinite(score)
                assert score >= 0 and (corrected or score <= 1 + 1e-9)
    for score in scores(assoc.correlation_ratio(df, ["z"], ["x", "y"], digits=None)).values():
        assert -1e-9 <= score <= 1 + 1e-9


def test_wide_columns_share_their_remainders(spark, tmp_path):
    """Two projections that Java compiles, and the same columns as one long one."""
    from featurespark.plans import views

    rows = [(i, i * 7 % 31, i % 5, float(i % 11)) for i in range(60)]
    rows += [(None, 1, 1, 1.0), (1, None, 1, 1.0), (1, 1, None, 1.0), (1, 1, 1, None), (2, 3, 4, float("inf"))]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    wide = views.wide(spark, str(tmp_path))
    want = lines.selectExpr(*(f"{views.wide_expression(k)} AS {c}" for k, c in enumerate(views.WIDE)))
    assert sorted(map(str, wide.collect())) == sorted(map(str, want.collect()))
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 2
