import pytest
from featurespark.operators import profile, rows
from featurespark.operators.profile import FeatureSpec


@pytest.fixture(scope="module")
def mixed(spark):
    data = [
        (f"s{i % 3}", float(i % 2), i, i % 2, i % 2 == 0, None if i % 2 else 4) for i in range(40)
    ]
    return spark.createDataFrame(
        data, "text string, real double, key int, flag int, truth boolean, gap int"
    )


def test_kinds(mixed):
    kinds = {r["column_name"]: r["kind"] for r in profile.column_kinds(mixed).collect()}
    assert kinds == {
        "text": "categorical",
        "real": "continuous",
        "key": "continuous",
        "flag": "categorical",
        "truth": "categorical",
        "gap": "categorical",
    }


def test_kind_threshold_is_inclusive(spark):
    df = spark.range(10).selectExpr("CAST(1 AS INT) AS one", "CAST(id % 2 AS INT) AS two")
    kinds = {r["column_name"]: r["kind"] for r in profile.column_kinds(df).collect()}
    assert kinds == {"one": "categorical", "two": "continuous"}


def test_kinds_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert {r["kind"] for r in profile.column_kinds(df).collect()} == {None}


def test_boolean_columns(mixed):
    got = {r["column_name"]: r["is_boolean"] for r in profile.boolean_columns(mixed).collect()}
    assert got == {
        "text": False, "real": True, "key": False, "flag": True, "truth": True, "gap": True
    }


def test_feature_spec(mixed):
    spec = FeatureSpec.infer(mixed, "flag")
    assert spec.continuous == ["real", "key"]
    assert spec.categorical == ["text", "truth", "gap"]
    assert spec.response_kind == "categorical"
    with pytest.raises(ValueError):
        FeatureSpec.infer(mixed, "absent")


def test_crosstab_fills_empty_cells(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "x string, y int")
    cells = {(r["x"], r["y"]): r["n"] for r in profile.crosstab(df, "x", "y").collect()}
    assert cells == {("a", 1): 2, ("a", 2): 0, ("b", 1): 0, ("b", 2): 1}
    wide = {r["x"]: (r["1"], r["2"]) for r in profile.crosstab_wide(df, "x", "y").collect()}
    assert wide == {"a": (2, 0), "b": (0, 1)}


def test_nonzero_mean(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 2.0), ("a", 4.0), ("b", 0.0)], "g string, x double")
    got = {r["g"]: r["nonzero_mean"] for r in profile.nonzero_mean(df, "x", ["g"]).collect()}
    assert got == {"a": 3.0, "b": None}


def test_approximate_quartiles_are_close(spark):
    df = spark.range(1001).selectExpr("CAST(id AS DOUBLE) AS x")
    got = profile.quartiles_approx(df, ["x"]).first()
    assert [got[f"q{i}"] for i in range(5)] == pytest.approx([0, 250, 500, 750, 1000], abs=1)


def test_stride(spark):
    df = spark.range(20).selectExpr("19 - id AS k")
    got = rows.stride_sample(df, ["k"], 7).orderBy("row_index").collect()
    assert [r["k"] for r in got] == [0, 7, 14]


def test_row_index_is_contiguous_with_a_hot_first_key(spark):
    df = spark.range(1000).selectExpr("CAST(greatest(id - 600, 0) AS INT) AS a", "id AS b")
    got = rows.with_row_index(df, ["a", "b"], partitions=5).collect()
    assert sorted((r["row_index"], r["b"]) for r in got) == [(i, i) for i in range(1000)]


def test_binarize(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "y string")
    assert [r["y"] for r in rows.binarize(df, "y").collect()] == [0, 1, 1, None]
    df = spark.createDataFrame([(0,), (1,), (1,)], "y int")
    assert [r["y"] for r in rows.binarize(df, "y").collect()] == [0, 1, 1]
    df = spark.createDataFrame([(1,), (2,), (2,)], "y int")
    assert [r["y"] for r in rows.binarize(df, "y").collect()] == [0, 1, 1]


def test_fill_zero(spark):
    df = spark.createDataFrame(
        [(None, None, float("nan")), ("x", 2, 1.5)], "s string, i int, d double"
    )
    assert [tuple(r) for r in rows.fill_zero(df).collect()] == [("0", 0, 0.0), ("x", 2, 1.5)]
    assert df.schema.simpleString() == rows.fill_zero(df).schema.simpleString()


def test_feature_label_split_skips_missing_if_asked(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b")], "k int, x double, y string")
    got = rows.feature_label_split(df, "y", keep=["k"], missing="skip").collect()
    assert [(r["k"], list(r["features"]), r["y"]) for r in got] == [(1, [2.0], "a")]
