import random

import numpy as np
import pytest
from featurespark.operators import profile
from featurespark.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def check(spark, groups, sort_rows):
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {
        (r["g"], r["prob"]): r["quantile"]
        for r in exact_quantiles(df, "x", PROBS, ["g"], sort_rows).collect()
    }
    assert len(got) == len(groups) * len(PROBS)
    for g, xs in groups.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(np.quantile(xs, p), rel=1e-12), (g, p)


@pytest.mark.parametrize("sort_rows", [20, 1_000_000])
def test_equal_to_sorting(spark, sort_rows):
    rng = random.Random(3)
    check(
        spark,
        {
            "uniform": [rng.random() for _ in range(800)],
            "hot": [5.0] * 500 + [rng.gauss(5, 1) for _ in range(300)],
            "wide": [10.0 ** rng.uniform(-250, 250) for _ in range(300)],
            "constant": [2.5] * 100,
            "one": [1.25],
            "two": [-1.0, 1.0],
        },
        sort_rows,
    )


def test_infinite_ends(spark):
    df = spark.createDataFrame(
        [(float("-inf"),), (1.0,), (2.0,), (4.0,), (float("inf"),)], "x double"
    ).selectExpr("'g' AS g", "x")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, "x", PROBS, ["g"], 1).collect()}
    assert got[0.25] == 1.0 and got[0.5] == 2.0 and got[0.75] == 4.0
    assert got[1.0] == float("inf")


def test_missing_values_and_null_groups(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, 3.0), ("a", None), ("a", float("nan")), ("a", 7.0)],
        "g string, x double",
    )
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == {(None, 0.5): 2.0, ("a", 0.5): 7.0}


def test_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    assert [tuple(r) for r in profile.quartiles(df, ["x"]).collect()] == [
        ("x", 1.0, 1.75, 3.0, 5.0, 8.0)
    ]


def test_empty(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, "x", [0.5], ["g"]).count() == 0
