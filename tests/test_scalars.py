"""Texts of numbers, and queries that compute anew."""

import random

from featurespark.functions.pvalues import scientific_column
from featurespark.operators import ml
from featurespark.plans import registry


def test_scientific_column_is_the_text_of_the_exact_value(spark):
    rng = random.Random(1)
    values = [round(rng.uniform(9e4, 1.1e5), 2) for _ in range(3000)]
    values += [100000 + k * 100 + c / 100 for k in range(100) for c in range(5, 100, 10)]
    values += [1234567.5, 1234568.5, 12345675.0, 0.00012345675, 0.12345665, 0.0, 9999999.5, 1e300]
    values += [-v for v in values]
    data = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = data.select("v", scientific_column("v").alias("t")).collect()
    assert [(r["v"], r["t"]) for r in got if r["v"] is not None and r["t"] != f"{r['v']:.6e}"] == []
    assert [r["t"] for r in got if r["v"] is None] == [None]


def test_importances_are_fitted_on_every_call(spark, monkeypatch):
    fits = []
    monkeypatch.setattr(ml, "forest_importance", lambda *args: fits.append(args) or spark.range(1))
    for _ in range(2):
        registry.rf_importance(spark, "/root/testdata/sf0.001")
    assert len(fits) == 2
