import random

import pytest
from featurespark.functions.bins import bin_left_closed, bin_right_closed, edges
from featurespark.operators import charts, msd
from pyspark.sql import functions as F


def test_bin_conventions(spark):
    xs = [i / 100 for i in range(11)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    cuts = edges(0.0, 0.1)
    got = df.select(
        bin_left_closed(F.col("x"), cuts).alias("l"), bin_right_closed(F.col("x"), cuts).alias("r")
    ).collect()
    assert [r["l"] for r in got] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert [r["r"] for r in got] == [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9]


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0, 1.0)] * 3, "x double, y double")
    table = msd.msd_1d(df, ["x"])
    counts = {r["bin"]: r["count"] for r in table.collect()}
    assert counts == {i: 3 if i == 9 else 0 for i in range(10)}
    assert msd.msd_1d_summary(table).first()["msd"] is None
    cells = msd.msd_2d_cont_cont(df, ["x"], "y").collect()
    assert [(r["bin1"], r["bin2"], r["n"]) for r in cells] == [("0", "0", 3)]


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(5)
    rows = [
        (rng.gauss(0, 1), rng.random(), rng.choice("ab"), rng.choice("xyz"), rng.randrange(2))
        for _ in range(500)
    ]
    return rows, spark.createDataFrame(rows, "p double, q double, g string, h string, y int")


def loop_bins(values, left_closed):
    """The bins spelt out interval by interval."""
    lo, hi = min(values), max(values)
    step = (hi - lo) / 10
    out = []
    for v in values:
        for i in range(10):
            low, high = lo + step * i, lo + step * (i + 1)
            last = (low <= v <= high) if i == 9 else (low <= v < high)
            first = (low <= v <= high) if i == 0 else (low < v <= high)
            if last if left_closed else first:
                out.append(i)
                break
        else:
            out.append(None)
    return out


def mean(xs):
    return sum(xs) / len(xs)


def median(xs):
    xs = sorted(xs)
    half = len(xs) // 2
    return xs[half] if len(xs) % 2 else (xs[half - 1] + xs[half]) / 2


@pytest.mark.parametrize("mode", [msd.REFERENCE, msd.STANDARD])
def test_1d_equals_a_loop(sample, mode):
    rows, df = sample
    got = {(r["feature"], r["bin"]): r for r in msd.msd_1d(df, ["p", "q"], "y", mode).collect()}
    for position, name in enumerate("pq"):
        values = [r[position] for r in rows]
        measure = [r[4] for r in rows] if mode == msd.STANDARD else values
        bins = loop_bins(values, True)
        assert sum(got[name, i]["count"] for i in range(10)) == len(rows)
        for i in range(10):
            inside = [k for k, b in enumerate(bins) if b == i]
            row = got[name, i]
            assert row["count"] == len(inside)
            if inside:
                gap = (mean([measure[k] for k in inside]) - mean(measure)) ** 2
                assert row["median"] == pytest.approx(median([values[k] for k in inside]))
                assert row["msd"] == pytest.approx(gap)
                assert row["weighted_msd"] == pytest.approx(gap * len(inside) / len(rows))
            else:
                assert row["msd"] == row["bin_mean"] == row["median"] == 0


@pytest.mark.parametrize("mode", [msd.REFERENCE, msd.STANDARD])
def test_2d_equals_a_loop(sample, mode):
    rows, df = sample
    keys = {
        "p": loop_bins([r[0] for r in rows], False),
        "q": loop_bins([r[1] for r in rows], False),
        "g": [r[2] for r in rows],
        "h": [r[3] for r in rows],
    }
    y = [r[4] for r in rows]

    def want(a, b, scaled_down):
        groups = {}
        for i, cell in enumerate(zip(keys[a], keys[b])):
            groups.setdefault(tuple(str(c) for c in cell), []).append(y[i])
        out = {}
        for cell, ys in groups.items():
            gap = (mean(ys) - mean(y)) ** 2
            weight = 1 / (len(ys) * len(y)) if scaled_down else len(ys) / len(y)
            out[cell] = (len(ys), pytest.approx(gap), pytest.approx(gap * weight))
        return out

    tables = [
        (msd.msd_2d_cont_cont(df, ["p", "q"], "y", mode), ["pp", "pq", "qq"], mode == msd.REFERENCE),
        (msd.msd_2d_cont_cat(df, ["p", "q"], ["g", "h"], "y"), ["pg", "ph", "qg", "qh"], False),
        (msd.msd_2d_cat_cat(df, ["g", "h"], "y"), ["gg", "gh", "hh"], False),
    ]
    for table, pairs, scaled_down in tables:
        got = {}
        for r in table.collect():
            pair = r["predictor1"] + r["predictor2"]
            got.setdefault(pair, {})[r["bin1"], r["bin2"]] = (r["n"], r["msd"], r["weighted_msd"])
        assert got == {pair: want(*pair, scaled_down) for pair in pairs}
        ranks = msd.msd_rank(table).collect()
        scores = [r["weighted_msd"] for r in ranks]
        assert scores == sorted(scores, reverse=True) and len(ranks) == len(pairs)


def test_no_predictors(sample):
    _, df = sample
    assert msd.msd_2d_cat_cat(df, [], "y").count() == 0
    assert msd.msd_rank(msd.msd_2d_cont_cat(df, ["p"], [], "y")).count() == 0
    assert msd.msd_1d(df, []).count() == 0


def test_missing_values_are_in_no_bin_but_count_as_rows(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (None,), (float("nan"),)], "x double")
    got = {r["bin"]: r for r in msd.msd_1d(df, ["x"]).collect()}
    assert got[0]["pop_proportion"] == 0.25 and got[9]["count"] == 1


def test_chart_centres(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    table = msd.msd_1d(df, ["x"])
    assert sorted(r["center"] for r in charts.msd_series(table).collect()) == [0.0, 9.0]
    standard = charts.msd_series(table, "standard").collect()
    assert sorted(r["center"] for r in standard) == [0.5, 9.5]


def test_box(spark):
    rows = [("a", float(x)) for x in [1, 2, 3, 4, 5, 100]] + [("b", 7.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in charts.box(df, "g", "x").collect()}
    assert (got["a"]["q1"], got["a"]["q3"], got["a"]["n_outliers"]) == (2.25, 4.75, 1)
    assert (got["a"]["lower_whisker"], got["a"]["upper_whisker"]) == (1.0, 5.0)
    assert got["b"]["iqr"] == 0.0 and got["b"]["n_outliers"] == 0
