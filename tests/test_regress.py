import random

import pytest
from featurespark.functions.pvalues import normal_two_sided, student_t_two_sided
from featurespark.operators import regress
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(400):
        a, b = rng.gauss(100, 20), rng.gauss(0, 1)
        y = 0.3 * a + rng.gauss(0, 15)
        rows.append((a, b, 5.0, y, int(y + rng.gauss(0, 10) > 30)))
    return spark.createDataFrame(rows, "a double, b double, c double, y double, flag int")


def test_t_distribution():
    assert student_t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert student_t_two_sided(12.7062047, 1) == pytest.approx(0.05, abs=1e-8)
    assert student_t_two_sided(0.0, 5) == 1.0
    # One degree of freedom is the Cauchy distribution, two have a closed form.
    assert student_t_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-12)
    assert student_t_two_sided(1.0, 2) == pytest.approx(1 - 3**-0.5, rel=1e-12)
    assert student_t_two_sided(1.9, 999_999) == pytest.approx(student_t_two_sided(1.9, 1_000_001), rel=1e-6)
    assert student_t_two_sided(1.96, 1e9) == pytest.approx(normal_two_sided(1.96), rel=1e-7)
    assert 0 < student_t_two_sided(40.0, 200) < 1e-90


def test_linear_fits_agree_with_mllib(data):
    fits = regress.with_ols_pvalues(regress.ols_per_feature(data, "y", ["a", "b", "c"]))
    got = {r["feature"]: r for r in fits.collect()}
    for name in ("a", "b"):
        vectors = VectorAssembler(inputCols=[name], outputCol="v").transform(data)
        model = LinearRegression(featuresCol="v", labelCol="y", solver="normal").fit(vectors)
        assert got[name]["slope"] == pytest.approx(model.coefficients[0], rel=1e-9)
        assert got[name]["intercept"] == pytest.approx(model.intercept, rel=1e-9)
        assert got[name]["t_value"] == pytest.approx(model.summary.tValues[0], rel=1e-8)
        assert got[name]["p_value"] == pytest.approx(model.summary.pValues[0], rel=1e-6, abs=1e-13)
        assert got[name]["r2"] == pytest.approx(model.summary.r2, rel=1e-8)
    assert got["c"]["t_value"] is None and got["c"]["p_value"] is None


def test_logistic_fits_agree_with_mllib(data):
    got = {r["feature"]: r for r in regress.logit_per_feature(data, "flag", ["a", "b", "c"]).collect()}
    for name in ("a", "b"):
        vectors = VectorAssembler(inputCols=[name], outputCol="v").transform(data)
        glm = GeneralizedLinearRegression(
            featuresCol="v", labelCol="flag", family="binomial", tol=1e-12, maxIter=100
        ).fit(vectors)
        assert got[name]["converged"]
        assert got[name]["slope"] == pytest.approx(glm.coefficients[0], rel=1e-6)
        assert got[name]["intercept"] == pytest.approx(glm.intercept, rel=1e-6)
        assert got[name]["z_value"] == pytest.approx(glm.summary.tValues[0], rel=1e-5)
        assert got[name]["p_value"] == pytest.approx(glm.summary.pValues[0], rel=1e-4, abs=1e-12)
    assert not got["c"]["converged"] and got["c"]["z_value"] is None


def test_perfect_separation_is_flagged(spark):
    df = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "x double, y int")
    got = regress.logit_per_feature(df, "y", ["x"]).first()
    assert not got["converged"] and got["z_value"] is None


def test_missing_rows_are_left_out(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (4.0, 8.5), (None, 1.0), (5.0, None), (float("nan"), 3.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = regress.ols_per_feature(df, "y", ["x"]).first()
    assert got["n"] == 4
    assert got["slope"] == pytest.approx(2.05)


def test_formatted(spark, data):
    fits = regress.with_ols_pvalues(regress.ols_per_feature(data, "y", ["b", "c"]))
    got = {r["feature"]: r["p_value"] for r in regress.formatted_stats(fits).collect()}
    assert got["c"] is None
    assert len(got["b"].split("e")[0]) == 8
