"""Sketches of days, kinds from sketches, wide cross tables, density curves."""

import datetime as dt
import math
import random
import statistics

import pytest
from featurespark.operators import charts, profile, sketches
from pyspark.sql import functions as F


def test_quantiles_of_any_range_of_days(spark):
    rng = random.Random(1)
    start = dt.date(2020, 1, 1)
    rows = [(start + dt.timedelta(days=rng.randrange(60)), rng.lognormvariate(0, 2), i) for i in range(20_000)]
    rows += [(None, 1.0, 1), (start, None, 2), (start, float("nan"), 3)]
    df = spark.createDataFrame(rows, "day date, v double, w int")
    stored = sketches.daily_quantile_sketches(df, ["v", "w"], "day").cache()
    first, last = start + dt.timedelta(days=7), start + dt.timedelta(days=40)
    merged = sketches.quantiles_of_days(stored, [0.1, 0.5, 0.99], F.lit(first), F.lit(last))
    chosen = sorted(v for d, v, _ in rows if d and first <= d <= last and v is not None and v == v)
    for r in merged.where("feature = 'v'").collect():
        assert r["n"] == len(chosen)
        less, up_to = sum(v < r["value"] for v in chosen), sum(v <= r["value"] for v in chosen)
        assert less <= (r["p"] + 0.01) * len(chosen) and up_to >= (r["p"] - 0.01) * len(chosen)
    # Sketches alone are read: the range costs no scan of the rows.
    kept = spark.createDataFrame(stored.toArrow(), stored.schema)
    plan = sketches.quantiles_of_days(kept, [0.5], F.lit(first))._jdf.queryExecution().executedPlan().toString()
    assert "kll_sketch_agg" not in plan and "kll_merge_agg" in plan


def test_kinds_from_sketches(spark):
    rows = [(i, i % 2, i % 100, i % 101, float(i), str(i), i % 3 == 0, dt.date(2020, 1, 1) + dt.timedelta(days=i % 90),
             None if i % 5 else 1, None) for i in range(1000)]
    schema = "a int, two long, at_limit int, above int, d double, s string, b boolean, day date, gaps int, `no.ne` int"
    df = spark.createDataFrame(rows, schema)
    for exact, sketched in ((profile.column_kinds, sketches.column_kinds), (profile.boolean_columns, sketches.boolean_columns)):
        data = df if exact is profile.column_kinds else df.drop("no.ne")
        data = data.drop("no.ne")
        assert sorted(map(tuple, sketched(data).collect())) == sorted(map(tuple, exact(data).collect()))
        assert sorted(map(tuple, sketched(data.limit(0)).collect()), key=str) == sorted(
            map(tuple, exact(data.limit(0)).collect()), key=str
        )
    assert {r["column_name"]: r["kind"] for r in sketches.column_kinds(df).collect()}["no.ne"] == "categorical"
    _, ranges = sketches.distinct_ranges(spark.range(50_000), ["id"])
    low, high = ranges["id"]
    assert low < 50_000 < high < 1.1 * low + 5_000


def test_cross_tables_of_any_width(spark):
    n = 50_000
    df = spark.range(n).selectExpr("id % 2 AS x", "concat('v', id % 30000) AS y").union(
        spark.createDataFrame([(None, "v1"), (1, None)], "x long, y string")
    )
    cells, values = profile.crosstab_sparse(df, "x", "y")
    assert values.count() == 30_000
    assert [tuple(r) for r in values.orderBy("y_index").limit(2).collect()] == [(0, "v0", 2), (1, "v1", 2)]
    assert tuple(cells.agg(F.sum("n"), F.max("y_index"), F.count("*")).first()) == (n, 29_999, 30_000)
    whole = profile.crosstab(df, "x", "y")
    assert tuple(whole.agg(F.count("*"), F.sum("n"), F.count_if(F.col("n") == 0)).first()) == (60_000, n, 30_000)


def test_density_curve(spark):
    rng = random.Random(4)
    rows = [(g, rng.gauss(5 * g, 1 + g)) for g in (0, 1) for _ in range(400)] + [(2, 3.0), (2, 3.0), (1, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    curve = charts.violin_curve(df, "g", "v", 200)
    values = {g: [v for h, v in rows if h == g and v is not None] for g in (0, 1)}
    for r in curve.where("g < 2 AND point % 20 = 0").collect():
        own = values[r["g"]]
        width = 1.06 * statistics.stdev(own) * len(own) ** -0.2
        plain = sum(math.exp(-((r["x"] - v) / width) ** 2 / 2) for v in own) / (len(own) * width * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(plain, abs=2e-3)
    areas = curve.groupBy("g").agg(F.sum("density").alias("total"), F.max("x").alias("hi"), F.min("x").alias("lo")).collect()
    for r in areas:
        if r["g"] < 2:
            assert 0.95 < r["total"] * (r["hi"] - r["lo"]) / 199 < 1.01
        else:
            assert r["total"] is None
